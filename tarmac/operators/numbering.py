"""Global order without a single-task window.

``row_number() OVER (ORDER BY ...)`` and running sums without ``PARTITION BY``
move every row into one task.  The two helpers here compute the same numbers in
parallel:

``global_row_number``
    Range-partition on the full ordering key (Spark samples the key, so even a
    date holding a third of all rows is cut across many tasks when the
    tie-breaking columns differ), sort within partitions, number rows inside each
    partition, and add the row count of all earlier partitions.  The per-partition
    numbering is materialised with a reliable ``checkpoint()`` (in the cluster's
    ``spark.checkpoint.dir``), or as Parquet in a folder of the caller's, so that a lost executor cannot renumber rows between
    the pass that counts partitions and the pass that applies the offsets.

``prefix_sums``
    Running sums of weight columns along one key (pre-aggregated to one row per
    key value, e.g. per score), in the same way: range partitions, sums inside each,
    shifted by the totals of earlier ranges (one row per range, broadcast).

``exact_quantiles`` builds on ``prefix_sums``: per-value counts, running counts,
first value whose cumulative share reaches p (``percentile_disc``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarmac.session import checkpoint_root, shuffles_removed


def _sort_cols(order: Sequence[str | Column]) -> list[Column]:
    return [F.col(c).asc_nulls_first() if isinstance(c, str) else c for c in order]


def global_row_number(
    df: DataFrame,
    order: Sequence[str | Column],
    out: str = "rn",
    partitions: int | None = None,
    folder: str | None = None,
) -> DataFrame:
    """1-based row number in the total order ``order``, computed in parallel.

    With ``folder`` the ranges are written there as Parquet (columns, compressed) instead of a checkpoint (whole rows);
    the caller removes it when the result has been used.

    Rows equal on every ordering column are ordered by a hash of the whole row, so that
    a value that very many rows share is still cut into several ranges; rows equal in
    every column are interchangeable.
    """
    checkpoint_root(df.sparkSession)
    hashable = [c for c, kind in df.dtypes if not kind.startswith(("map", "variant"))]
    cols = [*_sort_cols(order), F.xxhash64(*[F.col(f"`{c}`") for c in hashable])]
    pid = F.spark_partition_id().cast("long")
    # Without an explicit count the range exchange starts from the session's
    # initial partition number and AQE merges neighbouring ranges up to the
    # advisory size, so partition sizes follow the data volume; merged partitions
    # are contiguous, so partition ids stay in key order.
    by_range = df.repartitionByRange(partitions, *cols) if partitions else df.repartitionByRange(*cols)
    ranged = (
        by_range
        .sortWithinPartitions(*cols)
        .withColumn("_pid", pid)
        # monotonically_increasing_id = partition index << 33 | position in partition
        .withColumn("_local", F.monotonically_increasing_id() - F.shiftleft(pid, 33))
    )
    if folder:
        with shuffles_removed(df.sparkSession):
            ranged.write.parquet(folder)
        ranged = df.sparkSession.read.parquet(folder)
    else:
        ranged = ranged.checkpoint(eager=True)
    counts = ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_cnt"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    # at most `n` rows: one per range partition
    offsets = counts.select("_pid", F.coalesce(F.sum("_cnt").over(before), F.lit(0)).alias("_off"))
    return (
        ranged.join(F.broadcast(offsets), "_pid")
        .withColumn(out, F.col("_off") + F.col("_local") + 1)
        .drop("_pid", "_local", "_off")
    )


def prefix_sums(
    df: DataFrame,
    key: str,
    weights: Sequence[str],
    *,
    descending: bool = False,
    inclusive: bool = True,
    partitions: int | None = None,
) -> DataFrame:
    """Add ``cum_<w>`` (running sum along ``key``) and ``total_<w>`` per weight.

    ``df`` should hold one row per key value (aggregate first); with duplicate
    key values the running sums of the tied rows follow an arbitrary order.  Any
    orderable key works.  ``inclusive`` includes the current row.

    The rows are range-partitioned on the key, checkpointed (both passes over them
    see the same ranges), summed inside each range and shifted by the totals of the
    ranges before it; nothing but one total per range meets in one task.
    """
    checkpoint_root(df.sparkSession)
    order = F.col(key).desc_nulls_last() if descending else F.col(key).asc_nulls_first()
    ranged = df.repartitionByRange(partitions, order) if partitions else df.repartitionByRange(order)
    ranged = ranged.withColumn("_pid", F.spark_partition_id()).checkpoint(eager=True)
    # totals keep the weights' type, also where a range has none
    totals = ranged.groupBy("_pid").agg(*[F.sum(w).alias(f"_rt_{w}") for w in weights])
    earlier = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    # one row per range
    offsets = totals.select(
        "_pid",
        *[F.coalesce(F.sum(f"_rt_{w}").over(earlier), F.lit(0)).alias(f"_off_{w}") for w in weights],
        *[F.sum(f"_rt_{w}").over(everything).alias(f"total_{w}") for w in weights],
    )
    in_range = Window.partitionBy("_pid").orderBy(order).rowsBetween(
        Window.unboundedPreceding, Window.currentRow if inclusive else -1)
    running = ranged.select("*", *[F.coalesce(F.sum(w).over(in_range), F.lit(0)).alias(f"_run_{w}") for w in weights])
    return running.join(F.broadcast(offsets), "_pid").select(
        *df.columns,
        *[(F.col(f"_off_{w}") + F.col(f"_run_{w}")).alias(f"cum_{w}") for w in weights],
        *[F.col(f"total_{w}") for w in weights],
    )


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """(value, w): rows per distinct non-NULL value, partially aggregated."""
    return df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("w"))


def quantile_columns(column: str, probs: Sequence[float], names: Sequence[str] | None = None) -> list[Column]:
    """Aggregates that give the quantiles of ``prefix_sums(value_counts(df, column), column, ["w"])``."""
    names = list(names or [f"p{int(round(p * 100))}" for p in probs])
    return [
        F.min(F.when(F.col("cum_w") >= F.lit(p) * F.col("total_w"), F.col(column))).alias(name)
        for p, name in zip(probs, names)
    ]


def exact_quantiles(
    df: DataFrame,
    column: str,
    probs: Sequence[float],
    names: Sequence[str] | None = None,
) -> DataFrame:
    """One row: for each p the smallest value whose cumulative share is >= p.

    Same definition as SQL ``percentile_disc``.  The input is first reduced to
    (value, count) pairs with partial aggregation, so a value repeated across a
    third of the rows is one row after the map side.
    """
    return prefix_sums(value_counts(df, column), column, ["w"]).agg(*quantile_columns(column, probs, names))
