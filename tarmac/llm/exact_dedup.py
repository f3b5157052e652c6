"""Exact dedup with a heavy-hitter split.

Texts are equal when they are identical after lower-casing A-Z (null counts as the
empty text).  A group's row with the largest id stays.

1. Every row is reduced to (id, SHA-256 of the normalised text) in one pass over
   the texts and checkpointed.
2. Each task keeps a Misra-Gries summary of ``counters`` digests.  The summed
   summaries underestimate a digest's frequency by at most n / (counters + 1), so
   the digests whose summed estimate reaches that value are at most
   ``counters + 1`` and include every digest with at least 2 n / (counters + 1) rows.
3. The candidates' exact sizes and winners are counted (partial aggregation, so a
   hot digest is one row per task); those with copies are the verified winners.
   This table is bounded by construction and is broadcast: rows of frequent
   digests are settled map-side and never shuffled.
4. All other digests, none above 2 n / (counters + 1) rows, go through an ordinary
   shuffle on the digest.

Defined results: a null text equals an empty one; a null id ranks below every other id;
of rows that repeat the winning id exactly one stays; an empty table gives no rows.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarmac.llm.common import ascii_lower, checkpointed, packed_rows, text_or_empty, unpacked_rows

# Digests that one summary counts: the broadcast table has at most one row more.
DEFAULT_COUNTERS = 1024


def text_digest(text: str | Column) -> Column:
    """SHA-256 (32 bytes) of the normalised text in UTF-8."""
    return F.unhex(F.sha2(ascii_lower(text_or_empty(text)), 256))


def _reduced(counts: dict, counters: int) -> dict:
    """Subtract the (counters+1)-th largest count from all and drop what is spent."""
    if len(counts) <= counters:
        return counts
    values = np.fromiter(counts.values(), np.int64, len(counts))
    cut = int(np.partition(values, len(values) - counters - 1)[len(values) - counters - 1])
    return {k: c - cut for k, c in counts.items() if c > cut}


def misra_gries(df: DataFrame, column: str, counters: int = DEFAULT_COUNTERS) -> DataFrame:
    """(``column``, estimate): summed Misra-Gries summaries of all tasks.

    For a value of frequency f in n rows: f - n / (counters + 1) <= estimate <= f, and
    a value that is missing has f <= n / (counters + 1).  Nulls are not counted.
    """

    def summarise(batches):
        counts: Counter = Counter()
        for batch in batches:
            found = batch.column(0).drop_null().value_counts()
            for value, n in zip(found.field(0).to_pylist(), found.field(1).to_pylist()):
                counts[value] += n
            counts = Counter(_reduced(counts, counters))
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(counts.keys()), kind), pa.array(list(counts.values()), pa.int64())],
            names=[column, "estimate"],
        )

    field = df.schema[column]
    kind = {"binary": pa.binary(), "string": pa.string(), "bigint": pa.int64()}[field.dataType.simpleString()]
    parts = df.select(column).mapInArrow(summarise, f"`{column}` {field.dataType.simpleString()}, estimate long")
    return parts.groupBy(column).agg(F.sum("estimate").alias("estimate"))


def _digests(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One narrow row per input row; ``_n`` tells apart rows that repeat an id."""
    return checkpointed(
        df.select(
            F.col(id_col).alias("_id"),
            text_digest(text_col).alias("_digest"),
            F.monotonically_increasing_id().alias("_n"),
        )
    )


def heavy_winners(digests: DataFrame, counters: int = DEFAULT_COUNTERS) -> DataFrame:
    """(_digest, _win, _size) of the frequent digests; at most ``counters`` + 1 rows."""
    n = digests.count()
    candidates = (
        misra_gries(digests, "_digest", counters)
        .where(F.col("estimate") >= max(1.0, n / (counters + 1)))
        .select("_digest")
    )
    return checkpointed(
        digests.join(F.broadcast(candidates), "_digest")
        .groupBy("_digest")
        .agg(F.max(F.struct("_id", "_n")).alias("_win"), F.count(F.lit(1)).alias("_size"))
        .where("_size > 1")
    )


def dedup_report(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", counters: int = DEFAULT_COUNTERS
) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256 (lowercase hex)."""
    digests = _digests(df, id_col, text_col)
    heavy = heavy_winners(digests, counters)
    settled = digests.join(F.broadcast(heavy), "_digest")
    group = Window.partitionBy("_digest")
    rest = digests.join(F.broadcast(heavy.select("_digest")), "_digest", "left_anti").select(
        "_digest",
        "_id",
        "_n",
        F.max(F.struct("_id", "_n")).over(group).alias("_win"),
        F.count(F.lit(1)).over(group).alias("_size"),
    )
    return settled.unionByName(rest).select(
        F.col("_id").alias(id_col),
        F.col("_win._id").alias("keep_id"),
        F.col("_size").alias("group_size"),
        (F.col("_n") == F.col("_win._n")).alias("kept"),
        F.lower(F.hex("_digest")).alias("text_sha256"),
    )


def dedup_keep(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", counters: int = DEFAULT_COUNTERS
) -> DataFrame:
    """The rows that stay, with all their columns.

    Copies of frequent texts are dropped map-side; the texts of the rest are shuffled
    once, on their digest.
    """
    heavy = heavy_winners(_digests(df, id_col, text_col), counters)
    rows = packed_rows(df, F.col(id_col).alias("_id"), text_digest(text_col).alias("_digest"))
    left = rows.join(F.broadcast(heavy.select("_digest", F.col("_win._id").alias("_keep"), "_size")), "_digest", "left")
    left = left.where(F.col("_size").isNull() | F.col("_id").eqNullSafe(F.col("_keep")))
    order = Window.partitionBy("_digest").orderBy(F.col("_id").desc_nulls_last(), F.xxhash64("_row"))
    first = left.withColumn("_rank", F.row_number().over(order)).where("_rank = 1")
    return unpacked_rows(first)
