"""Schemas, canonical column names and required-column checks."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# --- fixed values: raw flight file layout (30 columns, data dictionary order) ---
RAW_COLUMNS = (
    "FL_DATE", "AIRLINE_CODE", "DOT_CODE", "FL_NUMBER", "ORIGIN", "ORIGIN_CITY",
    "DEST", "DEST_CITY", "CRS_DEP_TIME", "DEP_TIME", "DEP_DELAY", "TAXI_OUT",
    "WHEELS_OFF", "WHEELS_ON", "TAXI_IN", "CRS_ARR_TIME", "ARR_TIME", "ARR_DELAY",
    "CANCELLED", "CANCELLATION_CODE", "DIVERTED", "CRS_ELAPSED_TIME",
    "ELAPSED_TIME", "AIR_TIME", "DISTANCE", "DELAY_DUE_CARRIER",
    "DELAY_DUE_WEATHER", "DELAY_DUE_NAS", "DELAY_DUE_SECURITY",
    "DELAY_DUE_LATE_AIRCRAFT",
)

# --- fixed values: header renames, applied in this order; a rename happens only
# --- when its target is still absent, so AIRLINE wins over OP_CARRIER ---
RENAME_MAP = (
    ("FL_DATE", "flight_date"),
    ("AIRLINE", "airline"),
    ("OP_CARRIER", "airline"),
    ("ORIGIN", "origin"),
    ("DEST", "dest"),
    ("ARR_DELAY", "arr_delay"),
    ("DEP_DELAY", "dep_delay"),
    ("DISTANCE", "distance"),
    ("CANCELLATION_CODE", "cancellation_code"),
    ("CRS_DEP_TIME", "crs_dep_time"),
    ("DEP_TIME", "dep_time"),
)

# Canonical curated flight columns (order of the curated table).
CURATED_COLUMNS = (
    "flight_date", "airline", "origin", "dest", "cancellation_code",
    "arr_delay", "dep_delay", "distance", "crs_dep_time", "dep_hour",
    "year", "month", "day_of_week",
)

STRING_KEYS = ("airline", "origin", "dest", "cancellation_code")
MEASURES = ("arr_delay", "dep_delay", "distance")

# Rows without these are not usable for delay analytics (the "arrived" stage).
REQUIRED_FOR_DELAYS = ("flight_date", "airline", "origin", "dest", "arr_delay")
REQUIRED_FOR_TRAINING = ("arr_delay", "airline", "origin", "dest")
REQUIRED_FOR_STREAM = ("airline", "arr_delay")

# --- fixed values: replay / scoring stream layout (positional CSV columns) ---
STREAM_SCHEMA = T.StructType([
    T.StructField("flight_date", T.StringType()),
    T.StructField("airline", T.StringType()),
    T.StructField("origin", T.StringType()),
    T.StructField("dest", T.StringType()),
    T.StructField("arr_delay", T.DoubleType()),
    T.StructField("dep_delay", T.DoubleType()),
    T.StructField("distance", T.DoubleType()),
    T.StructField("month", T.IntegerType()),
    T.StructField("year", T.IntegerType()),
    T.StructField("day_of_week", T.StringType()),
])
STREAM_COLUMNS = tuple(f.name for f in STREAM_SCHEMA.fields)
# The aggregation stream reads only the first five columns.
AGG_STREAM_SCHEMA = T.StructType(STREAM_SCHEMA.fields[:5])


class MissingColumnsError(ValueError):
    """Raised when an operator's required columns are absent."""


def require_columns(df: DataFrame, columns: Iterable[str], op: str = "operator") -> None:
    """Raise a clear error naming the columns ``op`` needs but ``df`` lacks."""
    present = {c.lower() for c in df.columns}
    missing = [c for c in columns if c.lower() not in present]
    if missing:
        raise MissingColumnsError(f"{op} needs columns {missing}; input has {df.columns}")


def has_columns(df: DataFrame, columns: Iterable[str]) -> bool:
    present = {c.lower() for c in df.columns}
    return all(c.lower() in present for c in columns)

# Columns of a scored flight that pass through the model (fixed: consumers read them by name).
SCORED_COLUMNS = ("flight_date", "airline", "origin", "dest", "dep_delay", "distance", "arr_delay")
