"""Replaying history as a stream: recent-months filter and batch numbering.

``recent_months``   keeps the last N calendar months up to the newest date.  The
                    newest month is a scalar subquery inside the plan (no
                    ``collect``); the filter is written on year/month so that a
                    curated table partitioned by year/month prunes partitions at
                    runtime (Spark evaluates subqueries in partition filters
                    before listing files).
``batch_numbers``   numbers rows in date order (ties broken by every replayed
                    column, so the numbering is repeatable) and cuts the
                    sequence into batches of a fixed row count.
``replay_plan``     both, restricted to the columns the scoring stream reads.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.operators.ingest import fill_missing_derived
from tarmac.operators.numbering import global_row_number
from tarmac.schema import STREAM_COLUMNS

DEFAULT_ROWS_PER_BATCH = 20_000
DEFAULT_MONTHS = 3


def _month_index(year: Column, month: Column) -> Column:
    return year * 12 + (month - 1)


def recent_months(df: DataFrame, months: int = DEFAULT_MONTHS, date_col: str = "flight_date") -> DataFrame:
    """Rows of the newest ``months`` calendar months (inclusive of the newest)."""
    rows = df.where(F.col(date_col).isNotNull())
    if "year" in rows.columns and "month" in rows.columns:
        idx = _month_index(F.col("year"), F.col("month"))
    else:
        idx = _month_index(F.year(date_col), F.month(date_col))
    newest = rows.select(F.max(idx)).scalar()
    return rows.where(idx >= newest - F.lit(months - 1))


def replay_order(columns: Sequence[str], date_col: str = "flight_date") -> list[Column]:
    """Date first, then every other replayed column: a repeatable total order."""
    rest = [c for c in columns if c != date_col]
    return [F.col(date_col).asc_nulls_first()] + [F.col(c).asc_nulls_first() for c in rest]


def batch_numbers(
    df: DataFrame,
    rows_per_batch: int = DEFAULT_ROWS_PER_BATCH,
    order: Sequence[Column] | None = None,
    keep_rn: bool = False,
    partitions: int | None = None,
    folder: str | None = None,
) -> DataFrame:
    """Add ``batch_id`` = (row number - 1) div rows_per_batch, 0-based."""
    order = order or replay_order(df.columns)
    numbered = global_row_number(df, order, out="rn", partitions=partitions, folder=folder)
    out = numbered.withColumn("batch_id", ((F.col("rn") - 1) / F.lit(rows_per_batch)).cast("int"))
    return out if keep_rn else out.drop("rn")


def replay_rows(df: DataFrame, months: int | None = DEFAULT_MONTHS) -> DataFrame:
    """The scoring stream's columns (derived where missing), optionally recent only.

    The recent-months filter runs first, on the table's own year / month, so on a
    table partitioned by them it prunes folders before any row is read.
    """
    rows = df.where(F.col("flight_date").isNotNull())
    if months is not None:
        rows = recent_months(rows, months)
    rows = fill_missing_derived(rows)
    return rows.select(*[c for c in STREAM_COLUMNS if c in rows.columns])


def replay_plan(
    df: DataFrame,
    months: int | None = DEFAULT_MONTHS,
    rows_per_batch: int = DEFAULT_ROWS_PER_BATCH,
    keep_rn: bool = False,
    folder: str | None = None,
) -> DataFrame:
    """Recent rows with their replay ``batch_id`` (0-based); ``folder`` as in ``global_row_number``."""
    return batch_numbers(replay_rows(df, months), rows_per_batch, keep_rn=keep_rn, folder=folder)


def batch_profile(plan: DataFrame) -> DataFrame:
    """Per replay batch: rows, first/last date and the delay total (for checks)."""
    return (
        plan.groupBy("batch_id")
        .agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.min("flight_date").alias("first_date"),
            F.max("flight_date").alias("last_date"),
            F.sum("arr_delay").alias("sum_arr_delay"),
        )
        .orderBy("batch_id")
    )
