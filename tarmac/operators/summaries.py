"""Parameterised delay summaries.

One generic grouped summary (``delay_summary``) covers the per-airline, per-month,
per-route, per-airport and per-weekday tables; the distribution summary, the
correlation, the histogram and the share table are separate operators.

All of them are hash aggregates with partial (map-side) aggregation: a group
that holds a third of all rows is pre-aggregated inside every map task, so the
shuffle carries one partial row per (task, group), never the group's rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.functions.columns import WEEKDAYS, weekday_ordinal
from tarmac.operators.numbering import prefix_sums, quantile_columns, value_counts


def _as_list(x: str | Iterable[str]) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


def delay_summary(
    df: DataFrame,
    dims: str | Sequence[str],
    measures: str | Sequence[str] = ("arr_delay",),
    *,
    min_n: int | None = None,
    top_k: int | None = None,
    order_by: str | None = None,
    descending: bool = True,
    count_col: str = "n",
    count_first: bool = False,
) -> DataFrame:
    """``avg(measure)`` per measure and row count per group of ``dims``.

    ``min_n`` keeps groups with at least that many rows (inclusive), ``top_k``
    keeps the first k groups in the requested order; ties are broken by the
    dimension values so the result is repeatable.  Default order: the first
    average, descending.
    """
    dims = _as_list(dims)
    measures = _as_list(measures)
    avgs = [F.avg(m).alias(f"avg_{m}") for m in measures]
    count = F.count(F.lit(1)).alias(count_col)
    out = df.groupBy(*dims).agg(*([count] + avgs if count_first else avgs + [count]))
    if min_n is not None:
        out = out.filter(F.col(count_col) >= F.lit(min_n))
    key = order_by or f"avg_{measures[0]}"
    if key is not None:
        primary = F.col(key).desc_nulls_last() if descending else F.col(key).asc_nulls_last()
        out = out.orderBy(primary, *[F.col(d).asc_nulls_first() for d in dims])
    if top_k is not None:
        out = out.limit(top_k)
    return out


def weekday_summary(df: DataFrame, measure: str = "arr_delay") -> DataFrame:
    """Per weekday label, in calendar order (Mon..Sun) with its ordinal."""
    out = (
        df.groupBy("day_of_week")
        .agg(F.avg(measure).alias(f"avg_{measure}"), F.count(F.lit(1)).alias("n"))
        .withColumn("day_order", weekday_ordinal("day_of_week"))
    )
    return out.orderBy("day_order")


def count_by(df: DataFrame, dims: str | Sequence[str], count_col: str = "count") -> DataFrame:
    """Rows per group (NULL is a group of its own), most frequent first."""
    dims = _as_list(dims)
    return (
        df.groupBy(*dims)
        .agg(F.count(F.lit(1)).alias(count_col))
        .orderBy(F.col(count_col).desc(), *[F.col(d).asc_nulls_first() for d in dims])
    )


def share_pct(df: DataFrame, dims: str | Sequence[str], count_col: str = "count") -> DataFrame:
    """Rows per group and the group's percentage of all rows.

    The grand total is a scalar subquery over the aggregated table.
    """
    counted = count_by(df, dims, count_col)
    total = counted.agg(F.sum(count_col)).scalar()
    return counted.withColumn("share_pct", F.round(F.col(count_col) * 100.0 / total, 6))


# --- fixed values: the statistics of the distribution summary, in output order ---
SUMMARY_STATS = ("count", "mean", "stddev", "min", "25%", "50%", "75%", "max")


def distribution_summary(
    df: DataFrame,
    column: str = "arr_delay",
    digits: int = 6,
    approx_accuracy: int | None = None,
) -> DataFrame:
    """count, mean, stddev, min, quartiles, max of one column, one row each.

    Exact by default: the rows are read once, into (value, count) pairs with running
    counts along the value (one checkpoint); moments and quartiles (``percentile_disc``
    semantics: the first value whose cumulative share reaches p) are aggregates of that
    table, which holds one row per distinct value.  For a continuous column with very
    many values ``approx_accuracy`` gives ``percentile_approx`` quartiles (relative rank
    error 1/accuracy) in one aggregate without that table.  An empty column has count
    0 and NULL elsewhere; one row has no stddev.
    """
    x = F.col(column)
    probs = (0.25, 0.5, 0.75)
    names = ("25%", "50%", "75%")
    if approx_accuracy:
        quartiles = F.percentile_approx(x.cast("double"), list(probs), approx_accuracy)
        row = df.agg(
            F.count(x).alias("count"), F.avg(x).alias("mean"), F.stddev_samp(x).alias("stddev"),
            F.min(x).alias("min"), F.max(x).alias("max"), quartiles.alias("_q"),
        ).select("*", *[F.col("_q")[i].alias(n) for i, n in enumerate(names)])
    else:
        table = prefix_sums(value_counts(df, column), column, ["w"])
        v, w = x.cast("double"), F.col("w")
        first = table.agg(
            F.coalesce(F.sum(w), F.lit(0)).alias("count"), F.try_divide(F.sum(v * w), F.sum(w)).alias("mean"),
            F.min(v).alias("min"), F.max(v).alias("max"), *quantile_columns(column, probs, names),
        )
        # centred sum of squares: stable when the mean is large
        mean = first.select("mean").scalar()
        squares = table.agg(F.sum(w * (v - mean) * (v - mean)).alias("s")).scalar()
        row = first.withColumn("stddev", F.sqrt(F.try_divide(squares, F.col("count") - 1)))
    row = row.select(
        "*", F.round("mean", digits).alias("_mean"), F.round("stddev", digits).alias("_stddev")
    ).drop("mean", "stddev").withColumnsRenamed({"_mean": "mean", "_stddev": "stddev"})
    pairs = []
    for stat in SUMMARY_STATS:
        pairs += [F.lit(stat), F.col(f"`{stat}`").cast("double")]
    return row.select(F.stack(F.lit(len(SUMMARY_STATS)), *pairs).alias("summary", column))


def correlation(df: DataFrame, pairs: Sequence[tuple[str, str]], digits: int = 6) -> DataFrame:
    """Pearson correlation for each (x, y) pair, one row, NULL pairs skipped.

    Uses the SQL aggregate ``corr`` (pairs with a NULL are ignored), not
    ``df.stat.corr``.  Column names: ``{x}_{y}_corr``.
    """
    return df.agg(*[F.round(F.corr(a, b), digits).alias(f"{a}_{b}_corr") for a, b in pairs])


def histogram(
    df: DataFrame,
    column: str = "arr_delay",
    lower: float = -60.0,
    upper: float = 300.0,
    bins: int = 50,
) -> DataFrame:
    """Equal-width histogram of a clipped column.

    Values are clipped to [lower, upper]; the ``bins`` bins span the min..max of
    the clipped values, the last bin is closed.  The rows are read once: they are
    reduced to counts per distinct clipped value, and the bounds (a scalar
    subquery, no driver round trip) and bins come from that compact table.
    """
    clipped = F.least(F.greatest(F.col(column), F.lit(lower)), F.lit(upper))
    # one pass over the rows: counts per distinct clipped value (partial
    # aggregation); bounds and bins are then taken from this compact table, whose
    # exchange the bounds subquery reuses
    counts = (df.select(clipped.alias("_v")).where(F.col("_v").isNotNull())
              .groupBy("_v").agg(F.count(F.lit(1)).alias("_c")))
    b = counts.agg(F.struct(F.min("_v").alias("lo"), F.max("_v").alias("hi")).alias("b")).scalar()
    lo, width = b.getField("lo"), (b.getField("hi") - b.getField("lo")) / F.lit(bins)
    idx = F.when(width == 0, F.lit(0)).otherwise(
        F.least(F.floor((F.col("_v") - lo) / width), F.lit(bins - 1))
    ).cast("int")
    return (
        counts.groupBy(idx.alias("bin"))
        .agg(F.sum("_c").alias("n"))
        .select(
            "bin",
            F.round(lo + F.col("bin") * width, 6).alias("bin_lo"),
            F.round(lo + (F.col("bin") + 1) * width, 6).alias("bin_hi"),
            "n",
        )
        .orderBy("bin")
    )


def row_counts(df: DataFrame, label: str | None = "delayed") -> DataFrame:
    """Rows, and positives / negatives of a 0/1 label, in one pass."""
    aggs: list[Column] = [F.count(F.lit(1)).alias("n_rows")]
    if label:
        aggs += [
            F.count_if(F.col(label) == 1).alias("positive"),
            F.count_if(F.col(label) == 0).alias("negative"),
        ]
    return df.agg(*aggs)


def multi_dimension_summary(
    df: DataFrame,
    dimension_sets: Sequence[Sequence[str]],
    measure: str = "arr_delay",
) -> DataFrame:
    """Several grouped summaries in one scan with GROUPING SETS.

    Output: one row per group of each set, ``grouping_set`` naming the set
    (dimensions joined by '+'), dimension columns NULL where the set lacks them.
    """
    all_dims: list[str] = []
    for s in dimension_sets:
        for d in s:
            if d not in all_dims:
                all_dims.append(d)
    name = None
    for s in dimension_sets:
        gid = sum(1 << (len(all_dims) - 1 - i) for i, d in enumerate(all_dims) if d not in s)
        label = F.lit("+".join(s))
        name = F.when(F.grouping_id() == gid, label) if name is None else name.when(F.grouping_id() == gid, label)
    sets = [[F.col(d) for d in s] for s in dimension_sets]
    return df.groupingSets(sets, *all_dims).agg(
        name.alias("grouping_set"),
        F.avg(measure).alias(f"avg_{measure}"),
        F.count(F.lit(1)).alias("n"),
    )


__all__ = [
    "SUMMARY_STATS",
    "WEEKDAYS",
    "correlation",
    "count_by",
    "delay_summary",
    "distribution_summary",
    "histogram",
    "multi_dimension_summary",
    "row_counts",
    "share_pct",
    "weekday_summary",
]
