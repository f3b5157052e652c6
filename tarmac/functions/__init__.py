"""Column expressions: all built-in Spark functions, so they stay inside codegen."""

from tarmac.functions.columns import (
    DATE_PATTERNS,
    WEEKDAYS,
    delayed_label,
    hash_bucket,
    hhmm_to_hour,
    parse_date_multi,
    route_label,
    row_key,
    to_double,
    weekday_label,
    weekday_ordinal,
    year_month_label,
)

__all__ = [
    "DATE_PATTERNS",
    "WEEKDAYS",
    "delayed_label",
    "hash_bucket",
    "hhmm_to_hour",
    "parse_date_multi",
    "route_label",
    "row_key",
    "to_double",
    "weekday_label",
    "weekday_ordinal",
    "year_month_label",
]
