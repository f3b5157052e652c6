"""Summary tables from partial states, refreshed for the months that a load wrote.

The state table holds counts, sums, sums of squares, minima and maxima per month and group of
each dimension set.  States of disjoint rows add up, so any summary over any months is a small
aggregation of states, and a load recomputes only its own months: the scan of the curated table
is pruned to their partitions and only their state partitions are replaced.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.session import remove_folder
from tarmac.sinks.writers import write_curated
from tarmac.sources.files import read_curated

DIMENSION_SETS = (("airline",), ("origin",), ("dest",), ("origin", "dest"), ("day_of_week",), ())
STATE_MEASURES = ("arr_delay", "dep_delay")
CORRELATED = ("distance", "arr_delay")
PARTITIONS = ("year", "month")

Month = tuple[int, int]


def set_name(dims: Sequence[str]) -> str:
    return "+".join(dims) or "all"


def partial_states(df: DataFrame, dimension_sets: Sequence[Sequence[str]] = DIMENSION_SETS) -> DataFrame:
    """One row per month and group of each set, in one scan (``GROUPING SETS``)."""
    dims = list(dict.fromkeys(d for s in dimension_sets for d in s))
    keys = [*PARTITIONS, *dims]
    name = None
    for s in dimension_sets:
        absent = sum(1 << (len(keys) - 1 - i) for i, k in enumerate(keys) if k in dims and k not in s)
        when = F.when if name is None else name.when
        name = when(F.grouping_id() == absent, F.lit(set_name(s)))
    x, y = (F.col(c) for c in CORRELATED)
    both = x.isNotNull() & y.isNotNull()
    sums = [F.count(F.lit(1)).alias("n")]
    for m in STATE_MEASURES:
        v = F.col(m)
        sums += [F.count(v).alias(f"n_{m}"), F.sum(v).alias(f"s1_{m}"), F.sum(v * v).alias(f"s2_{m}"),
                 F.min(v).alias(f"min_{m}"), F.max(v).alias(f"max_{m}")]
    for label, value in (("n", F.lit(1)), ("x", x), ("y", y), ("xx", x * x), ("yy", y * y), ("xy", x * y)):
        sums.append(F.sum(F.when(both, value)).alias(f"c_{label}"))
    sets = [[F.col(k) for k in (*PARTITIONS, *s)] for s in dimension_sets]
    return df.groupingSets(sets, *keys).agg(name.alias("grouping_set"), *sums)


def months_of(df: DataFrame) -> list[Month]:
    """The months that rows belong to (one row per month reaches the driver)."""
    return sorted((r["year"], r["month"]) for r in df.select(*PARTITIONS).distinct().collect() if r["year"] is not None and r["month"] is not None)


def in_months(months: Iterable[Month]) -> Column:
    """A filter on the partition columns, so only these months' folders are listed."""
    return reduce(or_, [(F.col("year") == y) & (F.col("month") == m) for y, m in months], F.lit(False))


def refresh_states(spark: SparkSession, curated_path: str, state_path: str, months: Iterable[Month] | None = None) -> None:
    """Recompute the states of ``months`` (None: of all, replacing the table)."""
    rows = read_curated(spark, curated_path)
    wanted = None if months is None else sorted(set(months))
    if wanted is not None:
        if not wanted:
            return
        rows = rows.where(in_months(wanted))
    # a month's states are a few rows per group: one file each
    writer = partial_states(rows).repartition(*PARTITIONS).write.mode("overwrite")
    writer = writer.option("partitionOverwriteMode", "static" if wanted is None else "dynamic")
    writer.partitionBy(*PARTITIONS).parquet(state_path)
    if wanted is not None:  # a month without rows any more leaves no state behind
        for y, m in set(wanted) - set(months_of(rows)):
            remove_folder(spark, f"{state_path.rstrip('/')}/year={y}/month={m}")


def load_months(df: DataFrame, curated_path: str, state_path: str) -> list[Month]:
    """Replace the months that ``df`` holds in the curated table, and their states; returns them."""
    months = months_of(df)
    if months:
        write_curated(df, curated_path, only_written=True)
        refresh_states(df.sparkSession, curated_path, state_path, months)
    return months


def _spread(m: str) -> Column:
    n, s1, s2 = (F.col(f"{p}_{m}") for p in ("n", "s1", "s2"))
    return F.when(n > 1, F.sqrt(F.greatest(F.lit(0.0), (s2 - s1 * s1 / n) / (n - 1))))


def merged(states: DataFrame, dims: Sequence[str]) -> DataFrame:
    """Counts, means, deviations and extremes per group of ``dims`` (a dimension set, with or without year and month)."""
    name = set_name([d for d in dims if d not in PARTITIONS])
    adds = [F.sum(c).alias(c) for c in states.columns if c == "n" or c.split("_")[0] in ("n", "s1", "s2", "c")]
    ends = [getattr(F, p)(f"{p}_{m}").alias(f"{p}_{m}") for m in STATE_MEASURES for p in ("min", "max")]
    total = states.where(F.col("grouping_set") == name).groupBy(*dims).agg(*adds, *ends)
    out = []
    for m in STATE_MEASURES:
        out += [F.when(F.col(f"n_{m}") > 0, F.col(f"s1_{m}") / F.col(f"n_{m}")).alias(f"avg_{m}"), _spread(m).alias(f"sd_{m}"), f"min_{m}", f"max_{m}"]
    return total.select(*dims, "n", *out, *[c for c in total.columns if c.startswith("c_")])


def summary_from_states(states: DataFrame, dims: str | Sequence[str], measures: Sequence[str] = ("arr_delay",), *,
                        min_n: int | None = None, top_k: int | None = None) -> DataFrame:
    """``delay_summary`` without a scan of the flights: same columns, same order."""
    dims = [dims] if isinstance(dims, str) else list(dims)
    out = merged(states, dims).select(*dims, *[f"avg_{m}" for m in measures], "n")
    if min_n is not None:
        out = out.where(F.col("n") >= min_n)
    out = out.orderBy(F.col(f"avg_{measures[0]}").desc_nulls_last(), *[F.col(d).asc_nulls_first() for d in dims])
    return out.limit(top_k) if top_k is not None else out


def correlation_from_states(states: DataFrame) -> DataFrame:
    """Pearson correlation of distance and arrival delay from sums; NULL where either is constant."""
    n, x, y, xx, yy, xy = (F.col(f"c_{k}") for k in ("n", "x", "y", "xx", "yy", "xy"))
    spread = (n * xx - x * x) * (n * yy - y * y)
    return merged(states, []).select(F.when(spread > 0, (n * xy - x * y) / F.sqrt(spread)).alias("corr"))
