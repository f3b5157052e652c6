"""Packing documents into fixed windows by non-negative least squares.

1. Every document's token ids (plus an end id) are cut into whole windows and one
   remainder.  These pieces are never cut again.
2. The histogram of piece lengths (at most ``window`` bins, counted over all pieces) is
   all that the planner sees.  It enumerates shallow combinations of lengths that fill a
   window exactly: repeats of one length with one other length, and triples.
3. Non-negative least squares finds how often each combination should be used so that
   together they consume the histogram.  The counts are rounded, clipped to what is
   there, and what is left is packed greedily, largest length first, again by length and
   repeat count.  The plan has a bounded number of rows however many pieces there are.
4. Each piece gets its rank among the pieces of its length (per-partition ranks plus the
   counts of earlier partitions, so no length is numbered in one task), and the plan maps
   (length, rank) to a sequence and an offset with a join on the length.

Defined results: null and empty texts are one end id; an empty table gives no pieces;
repeated ids and rows are packed like any other rows.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tarmac.llm.common import checkpointed
from tarmac.llm.encoders import ID_TYPE, encoder

WINDOW = 4096
Combination = tuple[tuple[int, int], ...]  # ((length, repeats in the window), ...)

PIECES = "start long, length long, doc_tokens long, ids binary"


def tokenised_pieces(
    df: DataFrame, tokenizer_path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW
) -> DataFrame:
    """(id, start, length, doc_tokens, ids): the pieces of every document.

    ``ids`` holds little-endian unsigned 32-bit token ids.
    """
    end = np.array([end_id], ID_TYPE).tobytes()
    step = 4 * window

    def cut(batches: Iterable[pa.RecordBatch]):
        encode = encoder(tokenizer_path).encode
        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                part = batch.slice(at, 128)
                rows, starts, sizes, totals, ids = [], [], [], [], []
                for row, text in enumerate(part.column(1).to_pylist()):
                    buffer = encode(text or "") + end
                    for start in range(0, len(buffer), step):
                        piece = buffer[start : start + step]
                        rows.append(row)
                        starts.append(start // 4)
                        sizes.append(len(piece) // 4)
                        totals.append(len(buffer) // 4)
                        ids.append(piece)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).take(pa.array(rows, pa.int64())),
                        pa.array(starts, pa.int64()),
                        pa.array(sizes, pa.int64()),
                        pa.array(totals, pa.int64()),
                        pa.array(ids, pa.binary()),
                    ],
                    names=[id_col, "start", "length", "doc_tokens", "ids"],
                )

    id_type = df.schema[id_col].dataType.simpleString()
    return df.select(id_col, text_col).mapInArrow(cut, f"`{id_col}` {id_type}, {PIECES}")


# ---------------------------------------------------------------- the plan


def combinations(lengths: np.ndarray, counts: np.ndarray, window: int, partners: int = 8) -> np.ndarray:
    """Rows (length, repeats) x 3 of combinations that fill the window exactly.

    Unused places are (0, 0).  ``partners`` bounds how many second lengths a triple's
    first length is tried with (the most frequent ones).
    """
    have = np.zeros(window + 1, bool)
    have[lengths] = True
    found: list[tuple[int, int, int, int, int, int]] = []
    for a in lengths.tolist():
        for i in range(1, window // a + 1):
            rest = window - i * a
            if rest == 0:
                found.append((a, i, 0, 0, 0, 0))
            elif rest != a and have[rest]:
                found.append((a, i, rest, 1, 0, 0))
    frequent = lengths[np.argsort(-counts, kind="stable")]
    for a in lengths[lengths < window - 1].tolist():
        seconds = frequent[(frequent < window - a) & (frequent != a)][:partners]
        for b in seconds.tolist():
            c = window - a - b
            if have[c] and c not in (a, b):
                found.append((a, 1, b, 1, c, 1))
    return np.array(found, np.int64).reshape(-1, 6)


def solve_repeats(combos: np.ndarray, target: np.ndarray, steps: int = 400) -> np.ndarray:
    """Non-negative x minimising |A x - target|^2 (accelerated projected gradient).

    Column j of A holds how many pieces of each length one window of combination j takes.
    """
    lengths, repeats = combos[:, 0::2], combos[:, 1::2].astype(float)
    size = len(target)

    def used(x):
        return np.bincount(lengths.ravel(), (repeats * x[:, None]).ravel(), size)

    def back(r):
        return (repeats * r[lengths]).sum(axis=1)

    v = np.ones(len(combos))
    for _ in range(20):
        v = back(used(v))
        norm = np.linalg.norm(v)
        v /= norm
    x = np.zeros(len(combos))
    y, momentum = x, 1.0
    for _ in range(steps):
        following = np.maximum(0.0, y - back(used(y) - target) / (norm * 1.02))
        grown = (1 + np.sqrt(1 + 4 * momentum**2)) / 2
        y = following + (momentum - 1) / grown * (following - x)
        x, momentum = following, grown
    return x


def greedy_windows(left: dict[int, int], window: int) -> list[tuple[Combination, int]]:
    """Pack what is left: largest length first, then whatever fits best, repeated while it lasts."""
    plan = []
    sizes = sorted(k for k, n in left.items() if n > 0)
    while sizes:
        gap, combo, taken = window, [], {}
        while True:
            at = bisect.bisect_right(sizes, gap) - 1
            while at >= 0 and left[sizes[at]] - taken.get(sizes[at], 0) <= 0:
                at -= 1
            if at < 0:
                break
            length = sizes[at]
            n = min(gap // length, left[length] - taken.get(length, 0)) if combo else 1
            combo.append((length, n))
            taken[length] = taken.get(length, 0) + n
            gap -= n * length
        times = min(left[length] // n for length, n in taken.items())
        plan.append((tuple(sorted(taken.items(), reverse=True)), times))
        for length, n in taken.items():
            left[length] -= n * times
            if left[length] == 0:
                sizes.remove(length)
    return plan


def window_plan(histogram: dict[int, int], window: int = WINDOW) -> list[tuple[Combination, int]]:
    """[(combination, number of windows)]: consumes the histogram exactly."""
    left = {int(k): int(n) for k, n in histogram.items() if n > 0}
    lengths = np.array(sorted(left), np.int64)
    counts = np.array([left[k] for k in lengths.tolist()], np.int64)
    plan: list[tuple[Combination, int]] = []
    combos = combinations(lengths, counts, window) if len(lengths) else np.empty((0, 6), np.int64)
    if len(combos):
        target = np.zeros(window + 1)
        target[lengths] = counts
        x = solve_repeats(combos, target)
        order = np.argsort(-x, kind="stable")
        for rounding in (np.round, np.ceil):  # what rounding clips away, the second turn takes up
            for j in order[x[order] > 1e-3].tolist():
                combo = tuple((int(a), int(i)) for a, i in combos[j].reshape(3, 2) if i)
                times = min(int(rounding(x[j])), *(left[a] // i for a, i in combo))
                if times > 0:
                    plan.append((combo, times))
                    for a, i in combo:
                        left[a] -= i * times
                    x[j] -= times
    return plan + greedy_windows(left, window)


def plan_rows(plan: list[tuple[Combination, int]]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first rank, end rank, repeats, first sequence, first offset) of each combination's places."""
    rows, used, sequence = [], {}, 0
    for combo, times in plan:
        offset = 0
        for length, n in combo:
            first = used.get(length, 0)
            used[length] = first + n * times
            rows.append((length, first, first + n * times, n, sequence, offset))
            offset += n * length
        sequence += times
    return rows


# ------------------------------------------------------------- the placing


def place(pieces: DataFrame, id_col: str = "doc_id", window: int = WINDOW) -> DataFrame:
    """Add sequence_id and offset to pieces (id, start, length and any further columns).

    ``pieces`` is checkpointed: its partitions fix the ranks.
    """
    spark = pieces.sparkSession
    fixed = checkpointed(pieces.withColumn("_part", F.spark_partition_id()))
    per_part = fixed.groupBy("_part", "length").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy("length").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = per_part.select("_part", "length", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    histogram = {r["length"]: r["n"] for r in per_part.groupBy("length").agg(F.sum("_n").alias("n")).collect()}
    rows = plan_rows(window_plan(histogram, window))
    plan = spark.createDataFrame(
        rows or [(0, 0, 0, 1, 0, 0)],
        "length long, _first long, _end long, _repeats long, _sequence long, _offset long",
    )
    local = Window.partitionBy("_part", "length").orderBy(id_col, "start")
    ranked = (
        fixed.withColumn("_local", F.row_number().over(local) - 1)
        .join(before, ["_part", "length"])
        .withColumn("_rank", F.col("_before") + F.col("_local"))
    )
    at = F.col("_rank") - F.col("_first")
    # the plan's size depends on the window alone, never on the number of pieces
    return (
        ranked.join(F.broadcast(plan), "length")
        .where("_rank >= _first AND _rank < _end")
        .select(
            *pieces.columns,
            (F.col("_sequence") + F.floor(at / F.col("_repeats"))).cast("long").alias("sequence_id"),
            (F.col("_offset") + (at % F.col("_repeats")) * F.col("length")).cast("long").alias("offset"),
        )
    )


def sequences(placed: DataFrame, window: int = WINDOW, pad_id: int = 0) -> DataFrame:
    """(sequence_id, length, ids): whole windows from placed pieces that carry ``ids``.

    ``ids`` are padded to the window, unless the length is a power of two.  A window
    holds at most ``window`` ids, so gathering one is bounded.
    """
    pad = pad_id.to_bytes(4, "little").hex().upper()
    joined = placed.groupBy("sequence_id").agg(
        F.sum("length").alias("length"),
        F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("_parts"),
    )
    body = F.aggregate("_parts", F.lit("").cast("binary"), lambda acc, p: F.concat(acc, p["ids"]))
    exact = F.col("length").bitwiseAND(F.col("length") - 1) == 0
    return joined.select(
        "sequence_id",
        "length",
        F.when(exact, body)
        .otherwise(F.concat(body, F.unhex(F.repeat(F.lit(pad), (F.lit(window) - F.col("length")).cast("int")))))
        .alias("ids"),
    )
