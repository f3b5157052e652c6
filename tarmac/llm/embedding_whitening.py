"""Embedding whitening from exact integer scatter by bit-sliced counting.

Each entry c becomes the integer x = floor(64 * c) + 1,000,000.  A task takes its rows a
block at a time, shifts every dimension by its least x in the block, and packs each bit plane
of the shifted values across rows into 64-bit words.  A cross-product of two dimensions is then the
sum over their planes p and q of 2^(p + q) * popcount(plane p AND plane q): integers all the
way, so neither the blocks nor the order in which partial sums meet can change a digit.  The shift
is undone by the planes' own sums.  Partial sums leave a task as one decimal per pair of dimensions.

The driver holds d * d integers (d is the vectors' length): the covariance is centred there as
n * C - S * S' before the only division, and decomposed by ``eigh``.  Tasks get back
the leading components (at most 32 by d numbers).

Defined results: vectors that are null, empty, of another length than most (ties: the shorter
length), or hold null or non-finite entries take no part and give no row; entries whose 64-fold
is beyond 2^62 count as that bound; a direction without variance (an eigenvalue below
d * 2^-52 of the largest) is no component, so one row, equal rows or an empty table give none;
repeated rows and ids count every time and are whitened every time; null ids stay null.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SCALE = 64
OFFSET = 1_000_000
COMPONENTS = 32
# Rows whose bit planes are packed together.
BLOCK = 4096
_LIMIT = float(1 << 62)
_EXACT = pa.decimal128(38, 0)


def usable(vector: Column) -> Column:
    """Vectors that are there, not empty, and finite in every entry."""
    inf = F.lit(float("inf"))
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < inf))
    return F.coalesce(vector.isNotNull() & (F.size(vector) > 0) & finite, F.lit(False))


def integers(values: np.ndarray) -> np.ndarray:
    """floor(64 * c) + 1,000,000 of an array of doubles."""
    scaled = np.clip(np.floor(np.asarray(values, np.float64) * SCALE), -_LIMIT, _LIMIT)
    return scaled.astype(np.int64) + OFFSET


# ------------------------------------------------------------- bit planes


def packed_planes(y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bit planes of non-negative integers (rows x dims): words, dimension and bit of each plane.

    Planes without a bit are left out; a plane's rows lie in 64-bit words, the last one filled with zeros.
    """
    rows, dims = y.shape
    words, dimension, bit = [], [], []
    padded = np.zeros((-(-rows // 64) * 64, dims), np.uint8)
    for p in range(int(y.max(initial=0)).bit_length()):
        padded[:rows] = (y >> np.uint64(p)) & np.uint64(1)
        some = np.flatnonzero(padded.any(axis=0))
        packed = np.packbits(padded[:, some], axis=0)
        words.append(np.ascontiguousarray(packed.T).view(np.uint64))
        dimension.append(some)
        bit.append(np.full(len(some), p))
    if not words:
        return np.zeros((0, 0), np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    order = np.lexsort((np.concatenate(bit), np.concatenate(dimension)))
    return np.concatenate(words)[order], np.concatenate(dimension)[order], np.concatenate(bit)[order]


def block_scatter(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Exact sums of x_i and of x_i * x_j over the rows of one block, as Python integers."""
    rows, dims = x.shape
    least = x.min(axis=0)
    words, dimension, bit = packed_planes((x - least).view(np.uint64))
    common = np.zeros((len(words), len(words)), np.int64)
    for r in range(len(words)):
        common[r, r:] = np.bitwise_count(words[r:] & words[r]).sum(axis=1, dtype=np.int64)
    common = np.triu(common) + np.triu(common, 1).T
    wide = len(bit) > 0 and 2 * int(bit.max()) + 2 + rows.bit_length() > 62
    weight = np.array([1 << int(b) for b in bit], object if wide else np.int64)
    shifted = np.zeros(dims, object)
    cross = np.zeros((dims, dims), object)
    if len(words):
        first = np.flatnonzero(np.diff(dimension, prepend=-1))
        some = dimension[first]
        counts = common.astype(object) if wide else common
        halves = np.add.reduceat(counts * weight[:, None], first, axis=0)
        cross[np.ix_(some, some)] = np.add.reduceat(halves * weight, first, axis=1)
        shifted[some] = np.add.reduceat(counts.diagonal() * weight, first)
    low = least.astype(object)
    sums = shifted + low * rows
    cross = cross + np.outer(low, shifted) + np.outer(shifted, low) + np.outer(low, low) * rows
    return sums, cross


# --------------------------------------------------------------------- fit


@dataclass
class Whitening:
    """Rows, exact sums, and the leading components (rows of ``components``) with their eigenvalues."""

    rows: int
    dims: int
    sums: list[int]
    components: np.ndarray
    eigenvalues: np.ndarray
    explained: np.ndarray

    def centred(self, x: np.ndarray) -> np.ndarray:
        """n * x - S, exactly: 64-bit where that is wide enough."""
        highest = max([abs(s) for s in self.sums], default=0)
        reach = int(np.abs(x).max(initial=0)) * self.rows + highest
        wide = np.int64 if reach < 1 << 62 else object
        return x.astype(wide) * self.rows - np.array(self.sums, wide)

    def deviations(self, centred: np.ndarray) -> list[int]:
        reach = int(np.abs(centred).max(initial=0)) ** 2 * self.dims
        if centred.dtype == object or reach >= 1 << 62:
            centred = centred.astype(object)
        return (centred * centred).sum(axis=1).tolist()

    def project(self, centred: np.ndarray) -> np.ndarray:
        return (centred.astype(np.float64) / self.rows) @ self.components.T / np.sqrt(self.eigenvalues)


def _vectors(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dims)


def scatter(vectors: DataFrame, dims: int, block: int = BLOCK) -> tuple[int, list[int], np.ndarray]:
    """Rows, exact sums S and exact cross-products C of one column of vectors of one length."""

    def run(batches: Iterable[pa.RecordBatch]):
        rows, sums, cross, held, waiting = 0, np.zeros(dims, object), np.zeros((dims, dims), object), [], 0
        for batch in batches:
            for at in range(0, batch.num_rows, block):
                x = integers(_vectors(batch.column(0).slice(at, block), dims))
                held.append(x)
                waiting += len(x)
                if waiting >= block:
                    s, c = block_scatter(np.concatenate(held))
                    rows, sums, cross, held, waiting = rows + waiting, sums + s, cross + c, [], 0
        if waiting:
            s, c = block_scatter(np.concatenate(held))
            rows, sums, cross = rows + waiting, sums + s, cross + c
        if rows:
            upper = np.triu_indices(dims)
            i = np.concatenate([[-1], np.full(dims, -1), upper[0]])
            j = np.concatenate([[-1], np.arange(dims), upper[1]])
            values = [rows, *sums.tolist(), *cross[upper].tolist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array([Decimal(v) for v in values], _EXACT)],
                names=["i", "j", "v"],
            )

    parts = vectors.mapInArrow(run, "i int, j int, v decimal(38,0)")
    rows, sums, cross = 0, [0] * dims, np.zeros((dims, dims), object)
    # d * d / 2 numbers whatever the rows
    for r in parts.groupBy("i", "j").agg(F.sum("v").alias("v")).collect():
        if r["j"] < 0:
            rows = int(r["v"])
        elif r["i"] < 0:
            sums[r["j"]] = int(r["v"])
        else:
            cross[r["i"], r["j"]] = cross[r["j"], r["i"]] = int(r["v"])
    return rows, sums, cross


def decompose(rows: int, sums: list[int], cross: np.ndarray, components: int = COMPONENTS) -> Whitening:
    """Eigenvectors of the covariance (divisor n), centred as integers before the division."""
    dims = len(sums)
    s = np.array(sums, object)
    centred = cross * rows - np.outer(s, s)
    covariance = np.array([[float(v) for v in row] for row in centred.tolist()]).reshape(dims, dims) / max(1, rows) / max(1, rows)
    values, vectors = np.linalg.eigh(covariance)
    order = np.argsort(-values, kind="stable")[:components]
    order = order[values[order] > dims * 2.0**-52 * max(values.max(initial=0.0), 0.0)]
    return Whitening(rows, dims, sums, vectors[:, order].T.copy(), values[order], values[order] / max(np.trace(covariance), 1e-300))


def _prepared(df: DataFrame, vector_col: str) -> tuple[DataFrame, int]:
    """(_row, _vector) of the vectors that take part, and their length."""
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row"), F.col(f"`{vector_col}`").alias("_vector"))
    rows = rows.where(usable(F.col("_vector")))
    common = rows.groupBy(F.size("_vector").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "d").first()
    dims = common["d"] if common else 0
    return rows.where(F.size("_vector") == dims), dims


def fit(df: DataFrame, vector_col: str = "embedding", components: int = COMPONENTS) -> Whitening:
    """The whitening of all usable vectors."""
    rows, dims = _prepared(df, vector_col)
    return decompose(*scatter(rows.select("_vector"), dims), components)


# ------------------------------------------------------------------- apply


def transform(df: DataFrame, model: Whitening, vector_col: str = "embedding") -> DataFrame:
    """``_row`` of each usable vector of the model's length, ``deviation`` and ``whitened`` (an array).

    ``deviation`` is a decimal of 38 digits, NULL beyond that.
    """
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row"), F.col(f"`{vector_col}`").alias("_vector"))
    rows = rows.where(usable(F.col("_vector")) & (F.size("_vector") == model.dims))
    kind = rows.schema["_row"].dataType.simpleString()
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterable[pa.RecordBatch]):
        own = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                centred = own.centred(integers(_vectors(part.column(1), own.dims)))
                exact = [Decimal(v) if v < 10**38 else None for v in own.deviations(centred)]
                whitened = own.project(centred)
                offsets = np.arange(0, whitened.size + 1, max(1, whitened.shape[1]), np.int32)
                if not whitened.shape[1]:
                    offsets = np.zeros(len(whitened) + 1, np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(whitened.ravel(), pa.float64()))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(exact, _EXACT), lists], names=["_row", "deviation", "whitened"]
                )

    return rows.mapInArrow(run, f"_row {kind}, deviation decimal(38,0), whitened array<double>")


def identity_error(whitened: DataFrame, components: int) -> float:
    """Largest absolute entry of the covariance of a column ``whitened`` minus the identity.

    Measured on the rows themselves: partial sums per task, one aggregation of k * k numbers.
    """
    if not components:
        return 0.0

    def run(batches: Iterable[pa.RecordBatch]):
        rows, sums, cross = 0, np.zeros(components), np.zeros((components, components))
        for batch in batches:
            w = _vectors(batch.column(0), components)
            rows, sums, cross = rows + len(w), sums + w.sum(axis=0), cross + w.T @ w
        if rows:
            i = np.concatenate([[-1], np.full(components, -1), np.repeat(np.arange(components), components)])
            j = np.concatenate([[-1], np.arange(components), np.tile(np.arange(components), components)])
            yield pa.RecordBatch.from_arrays(
                [pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(np.concatenate([[rows], sums, cross.ravel()]))],
                names=["i", "j", "v"],
            )

    parts = whitened.select("whitened").mapInArrow(run, "i int, j int, v double")
    found = {(r["i"], r["j"]): r["v"] for r in parts.groupBy("i", "j").agg(F.sum("v").alias("v")).collect()}
    rows = found.get((-1, -1), 0.0)
    if not rows:
        return 0.0
    mean = np.array([found[-1, j] for j in range(components)]) / rows
    second = np.array([[found[i, j] for j in range(components)] for i in range(components)]) / rows
    return float(np.abs(second - np.outer(mean, mean) - np.eye(components)).max())
