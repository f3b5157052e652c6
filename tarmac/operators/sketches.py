"""Quantiles of any range of months from mergeable sketches, without a sort of the flights.

A sketch table holds one KLL sketch per month, group and measure, beside the month states of
``partials``: a load refreshes only its own months, and a quantile over any months merges their sketches.
Sketches are built by a partial aggregation (one sketch per task and group reaches the shuffle), so a
month or group with a third of all rows moves as little as any other.

A quantile's rank is off by at most ``RANK_ERROR`` of the rows (the sketch's own bound at ``K`` is about a
seventh of that, with 99 % confidence); least and greatest value are exact.  NULL and NaN are left out; a
group without values has no quantiles.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.operators.partials import PARTITIONS, Month, in_months, months_of
from tarmac.session import remove_folder
from tarmac.sources.files import read_curated

MEASURES = ("arr_delay", "dep_delay", "distance")
QUARTILES = (0.0, 0.25, 0.5, 0.75, 1.0)
# Size parameter of the sketches, and the rank error that the tests hold them to.
K = 2000
RANK_ERROR = 0.01


def month_sketches(df: DataFrame, measures: Sequence[str] = MEASURES, dims: Sequence[str] = (), k: int = K) -> DataFrame:
    """(year, month, dims, measure, n, sketch): one row per month, group and measure that has values."""
    pairs = F.explode(F.array(*[F.struct(F.lit(m).alias("measure"), F.col(m).cast("double").alias("value")) for m in measures]))
    values = df.select(*PARTITIONS, *dims, pairs.alias("_m")).select(*PARTITIONS, *dims, "_m.measure", "_m.value")
    usable = values.where(F.col("value").isNotNull() & ~F.isnan("value"))
    return usable.groupBy(*PARTITIONS, *dims, "measure").agg(
        F.count(F.lit(1)).alias("n"), F.kll_sketch_agg_double("value", F.lit(k)).alias("sketch"))


def refresh_sketches(spark: SparkSession, curated_path: str, sketch_path: str, months: Iterable[Month] | None = None,
                     measures: Sequence[str] = MEASURES, dims: Sequence[str] = (), k: int = K) -> None:
    """Rebuild the sketches of ``months`` (None: of all, replacing the table); other months are not scanned."""
    rows = read_curated(spark, curated_path)
    wanted = None if months is None else sorted(set(months))
    if wanted is not None:
        if not wanted:
            return
        rows = rows.where(in_months(wanted))
    writer = month_sketches(rows, measures, dims, k).repartition(*PARTITIONS).write.mode("overwrite")
    writer = writer.option("partitionOverwriteMode", "static" if wanted is None else "dynamic")
    writer.partitionBy(*PARTITIONS).parquet(sketch_path)
    if wanted is not None:
        for y, m in set(wanted) - set(months_of(rows)):
            remove_folder(spark, f"{sketch_path.rstrip('/')}/year={y}/month={m}")


def merged_sketches(sketches: DataFrame, dims: Sequence[str] = (), k: int = K) -> DataFrame:
    """(dims, measure, n, sketch) over the months that ``sketches`` holds."""
    return sketches.groupBy(*dims, "measure").agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch", F.lit(k)).alias("sketch"))


def quantiles(sketches: DataFrame, probabilities: Sequence[float] = QUARTILES, dims: Sequence[str] = (), k: int = K) -> DataFrame:
    """(dims, measure, n, p, value): the value at each rank share ``p``, one row per group, measure and share."""
    ps = F.array(*[F.lit(float(p)) for p in probabilities])
    found = merged_sketches(sketches, dims, k).withColumn("_values", F.kll_sketch_get_quantile_double("sketch", ps))
    each = F.explode(F.arrays_zip(ps.alias("p"), F.col("_values").alias("value")))
    return found.select(*dims, "measure", "n", each.alias("_q")).select(*dims, "measure", "n", "_q.p", "_q.value")


def rank_shares(df: DataFrame, found: DataFrame, measures: Sequence[str] = MEASURES) -> DataFrame:
    """``found`` (measure, p, value, ...) with ``below`` and ``upto``: the shares of rows below and up to each value.

    One scan of ``df``, compared with every quantile (a few rows, broadcast): what a sketch is checked by.
    """
    pairs = F.explode(F.array(*[F.struct(F.lit(m).alias("measure"), F.col(m).cast("double").alias("x")) for m in measures]))
    values = df.select(pairs.alias("_m")).select("_m.measure", "_m.x").where(F.col("x").isNotNull() & ~F.isnan("x"))
    rest = [c for c in found.columns if c != "measure"]
    points = found.groupBy("measure").agg(F.collect_list(F.struct(*rest)).alias("_points"))
    each = values.join(F.broadcast(points), "measure").select("measure", "x", F.explode("_points").alias("_q"))
    # merging sketches is randomised: the values that are returned are those that were compared
    shares = each.groupBy("measure", "_q").agg(
        F.avg((F.col("x") < F.col("_q.value")).cast("int")).alias("below"), F.avg((F.col("x") <= F.col("_q.value")).cast("int")).alias("upto"))
    return shares.select("measure", "_q.*", "below", "upto")


def rank_error(p: Column, below: Column, upto: Column) -> Column:
    """How far ``p`` lies outside the shares of rows below and up to a quantile (0: inside)."""
    return F.greatest(below - p, p - upto, F.lit(0.0))
