"""Repeatable splits and samples keyed by a hash of row content.

``randomSplit`` and ``sample`` depend on partitioning and row order; the same
data read with a different file layout or cluster size gives another split.  A
hash of the row's key columns does not: a row always lands on the same side.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.functions.columns import hash_bucket, row_key


def with_split(
    df: DataFrame,
    key_cols: Sequence[str],
    train_pct: int = 70,
    out: str = "split",
) -> DataFrame:
    """Tag each row 'train' (hash bucket < train_pct of 100) or 'test'."""
    bucket = hash_bucket(row_key(key_cols), 100)
    return df.withColumn(out, F.when(bucket < F.lit(train_pct), F.lit("train")).otherwise(F.lit("test")))


def train_test_split(
    df: DataFrame,
    key_cols: Sequence[str],
    train_pct: int = 70,
) -> tuple[DataFrame, DataFrame]:
    tagged = with_split(df, key_cols, train_pct, out="_split")
    train = tagged.where(F.col("_split") == "train").drop("_split")
    test = tagged.where(F.col("_split") == "test").drop("_split")
    return train, test


_PREFIX_SPACE = 1 << 32  # the first 8 hex digits of md5


def _hash_prefix(h: Column) -> Column:
    return F.conv(F.substring(h, 1, 8), 16, 10).cast("bigint")


def bounded_sample(df: DataFrame, limit: int, key_cols: Sequence[str]) -> DataFrame:
    """Exactly the ``limit`` rows with the smallest md5(key) (ties by key).

    A plain ``orderBy().limit()`` keeps ``limit`` rows per task and merges them
    in one task, which grows with the number of tasks.  Here one aggregate pass
    counts the rows under a ladder of hash cut-offs (1, 1/2, 1/4, ... of the hash
    space); only rows under the smallest cut-off that still holds ``limit`` rows
    enter the top-k.  That is exact — every row above the cut-off sorts after all
    rows below it — and the top-k then sees about ``limit``-to-2x-``limit`` rows
    (more only when many rows are copies of one key, which share a hash).
    """
    h = F.md5(row_key(key_cols))
    prefix = _hash_prefix(h)
    ladder = [_PREFIX_SPACE >> j for j in range(0, 32)]
    stats = df.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count_if(prefix < F.lit(c)).alias(f"c{j}") for j, c in enumerate(ladder)],
    ).first()
    cutoff = _PREFIX_SPACE
    for j, c in enumerate(ladder):
        if stats[f"c{j}"] >= limit:
            cutoff = c
    order = [F.col("_h")] + [F.col(c).asc_nulls_first() for c in key_cols]
    candidates = df.withColumn("_h", h)
    if cutoff < _PREFIX_SPACE:
        candidates = candidates.where(_hash_prefix(F.col("_h")) < F.lit(cutoff))
    return candidates.orderBy(*order).limit(limit).drop("_h")
