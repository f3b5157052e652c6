"""Ingest and cleaning: raw text flights -> typed, deduplicated, curated rows.

Stages (kept apart on purpose, see the cancellation count):

* ``normalise`` – rename headers, parse dates, cast measures, trim codes.
* ``clean``     – ``normalise`` + full-row de-duplication + derived columns.
                  Cancelled flights are still here (their arr_delay is NULL),
                  so cancellations are counted on this stage.
* ``arrived``   – ``clean`` without rows missing a required column.

All steps are column expressions plus one aggregate (the de-duplication), which
Spark plans as a partial + final hash aggregate: copies of a row collapse inside
each map task before the shuffle, so even a row repeated across a third of the
input sends at most one copy per task to its reducer.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarmac.functions.columns import (
    hhmm_to_hour,
    parse_date_multi,
    to_double,
    weekday_label,
)
from tarmac.schema import (
    MEASURES,
    RENAME_MAP,
    REQUIRED_FOR_DELAYS,
    STRING_KEYS,
)


def header_renames(columns: Sequence[str], mapping=RENAME_MAP) -> dict[str, str]:
    """Which columns to rename: first match wins, only while the target is absent.

    Names are compared case-insensitively, like Spark's default resolution.
    Works on the schema only; no data is touched.
    """
    original = list(columns)
    current = list(columns)
    renames: dict[str, str] = {}
    for old, new in mapping:
        lowered = [c.lower() for c in current]
        if old.lower() not in lowered:
            continue
        idx = lowered.index(old.lower())
        # target present as another column (e.g. AIRLINE already became airline)
        if any(i != idx and c == new.lower() for i, c in enumerate(lowered)):
            continue
        if current[idx] != new:
            renames[original[idx]] = new
            current[idx] = new
    return renames


def rename_headers(df: DataFrame, mapping=RENAME_MAP) -> DataFrame:
    """Raw header names -> canonical names in one projection."""
    renames = header_renames(df.columns, mapping)
    return df.withColumnsRenamed(renames) if renames else df


def normalise(df: DataFrame) -> DataFrame:
    """Rename, parse and trim; every step runs only if its column exists."""
    df = rename_headers(df)
    types = {f.name: f.dataType for f in df.schema.fields}
    replacements = {}
    if "flight_date" in types:
        dt = types["flight_date"]
        if isinstance(dt, T.StringType):
            replacements["flight_date"] = parse_date_multi("flight_date")
        elif not isinstance(dt, T.DateType):
            replacements["flight_date"] = F.to_date("flight_date")
    for c in MEASURES:
        if c in types and not isinstance(types[c], T.DoubleType):
            replacements[c] = to_double(c)
    for c in STRING_KEYS:
        if c in types:
            replacements[c] = F.trim(F.col(c))
    for c in ("crs_dep_time", "dep_time"):
        if c in types and not isinstance(types[c], T.IntegerType):
            replacements[c] = F.floor(to_double(c)).cast("int")
    return df.withColumns(replacements) if replacements else df


def add_derived(df: DataFrame) -> DataFrame:
    """year, month, weekday label and departure hour, when their inputs exist."""
    derived = {}
    if "flight_date" in df.columns:
        if "year" not in df.columns:
            derived["year"] = F.year("flight_date")
        if "month" not in df.columns:
            derived["month"] = F.month("flight_date")
        if "day_of_week" not in df.columns:
            derived["day_of_week"] = weekday_label("flight_date")
    if "crs_dep_time" in df.columns and "dep_hour" not in df.columns:
        derived["dep_hour"] = hhmm_to_hour("crs_dep_time")
    return df.withColumns(derived) if derived else df


def fill_missing_derived(df: DataFrame) -> DataFrame:
    """Keep year / month / weekday where present, derive them where NULL."""
    fills = {}
    d = F.col("flight_date")
    if "year" in df.columns:
        fills["year"] = F.coalesce(F.col("year"), F.year(d))
    if "month" in df.columns:
        fills["month"] = F.coalesce(F.col("month"), F.month(d))
    if "day_of_week" in df.columns:
        fills["day_of_week"] = F.coalesce(F.col("day_of_week"), weekday_label(d))
    out = df.withColumns(fills) if fills else df
    return add_derived(out)


def coalesce_spellings(df: DataFrame, target: str, spellings: Sequence[str]) -> DataFrame:
    """Merge columns that spell the same field differently into ``target``.

    Under the default case-insensitive resolution ``arr_delay`` and ``ARR_DELAY``
    are one column and this is a no-op; with ``spark.sql.caseSensitive`` on both
    can exist, and the first non-NULL value wins (``target`` first).
    """
    present = [c for c in dict.fromkeys([target, *spellings]) if c in df.columns]
    if len(present) <= 1:
        return df.withColumnRenamed(present[0], target) if present and present[0] != target else df
    merged = F.coalesce(*[F.col(f"`{c}`") for c in present])
    others = [c for c in df.columns if c not in present]
    return df.select(*[F.col(f"`{c}`") for c in others], merged.alias(target))


def dedup_rows(df: DataFrame) -> DataFrame:
    """Drop full-row duplicates (partial aggregation before the shuffle)."""
    return df.dropDuplicates()


def clean(df: DataFrame) -> DataFrame:
    """normalise -> de-duplicate -> derive.

    De-duplicating after normalising catches rows that only become equal once
    trimmed / parsed; doing it before deriving keeps the shuffled rows narrow.
    """
    return add_derived(dedup_rows(normalise(df)))


def drop_null_required(df: DataFrame, required: Iterable[str] = REQUIRED_FOR_DELAYS) -> DataFrame:
    """Drop rows NULL in any required column.

    Written as a conjunction of ``IS NOT NULL`` predicates rather than ``dropna``
    (one opaque expression over all columns), so the optimizer can push each
    predicate to the join side or scan that produces its column.
    """
    present = [c for c in required if c in df.columns]
    if not present:
        return df
    cond = F.col(present[0]).isNotNull()
    for c in present[1:]:
        cond = cond & F.col(c).isNotNull()
    return df.where(cond)


def arrived(df: DataFrame, required: Iterable[str] = REQUIRED_FOR_DELAYS) -> DataFrame:
    """Rows usable for delay analytics."""
    return drop_null_required(df, required)


def drop_null_any(df: DataFrame) -> DataFrame:
    return df.na.drop(how="any")


def curated_projection(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Select the canonical columns that exist, in canonical order."""
    return df.select(*[c for c in columns if c in df.columns])
