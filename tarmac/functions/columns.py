"""Column builders used by the operators.

Spark 4 runs with ANSI mode on: ``to_date`` and ``cast`` raise on dirty text, so
parsing goes through the ``try_*`` variants, which yield NULL instead.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: accepted textual date layouts, tried in this order ---
DATE_PATTERNS = ("yyyy-MM-dd", "M/d/yyyy", "MM/dd/yyyy")

# --- fixed values: weekday labels produced by date_format(d, 'E'), calendar order ---
WEEKDAYS = ("Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun")


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _may_have_layout(col: Column, pattern: str) -> Column:
    """Whether the text holds the pattern's separators, without which it cannot parse.

    Patterns with quotes, optional parts or other special characters take any text.
    """
    found = F.lit(True)
    if not set(pattern) & set("'[]{}#"):
        for c in sorted({c for c in pattern if not c.isalpha()}):
            found = found & col.contains(c)
    return found


def parse_date_multi(c: str | Column, patterns: Iterable[str] = DATE_PATTERNS) -> Column:
    """First pattern that parses wins; unparsable text becomes NULL.

    A layout is tried only on text with its separators: a failed attempt costs an
    exception, some twenty times the time of a date that parses.
    """
    col = _col(c)
    return F.coalesce(*[F.when(_may_have_layout(col, p), F.try_to_date(col, p)) for p in patterns])


def to_double(c: str | Column) -> Column:
    """Text or number to double; non-numeric text becomes NULL."""
    return _col(c).try_cast("double")


def hhmm_to_hour(c: str | Column) -> Column:
    """Hour of an HHMM clock value: '0550' -> 5, '5' -> 0, 2400 -> 24, 'x' -> NULL."""
    return F.floor(to_double(c) / 100).cast("int")


def weekday_label(date: str | Column) -> Column:
    """Mon ... Sun."""
    return F.date_format(_col(date), "E")


def weekday_ordinal(label: str | Column) -> Column:
    """1 for Mon ... 7 for Sun, for calendar ordering of weekday labels."""
    return F.array_position(F.array(*[F.lit(d) for d in WEEKDAYS]), _col(label)).cast("int")


def route_label(origin: str | Column = "origin", dest: str | Column = "dest", sep: str = "→") -> Column:
    return F.concat_ws(sep, _col(origin), _col(dest))


def year_month_label(year: str | Column = "year", month: str | Column = "month") -> Column:
    """Zero-padded ``yyyy-MM``."""
    return F.format_string("%d-%02d", _col(year), _col(month))


def delayed_label(arr_delay: str | Column = "arr_delay", threshold: float = 15.0) -> Column:
    """1 when the delay is strictly above ``threshold``, 0 otherwise, NULL stays NULL."""
    col = _col(arr_delay)
    return F.when(col > F.lit(threshold), F.lit(1)).when(col.isNotNull(), F.lit(0)).cast("int")


def row_key(columns: Iterable[str | Column], sep: str = "|") -> Column:
    """Text key of a row: the given columns joined by ``sep`` (NULL as empty)."""
    return F.concat_ws(sep, *[F.coalesce(_col(c).cast("string"), F.lit("")) for c in columns])


def hash_bucket(key: Column, buckets: int = 100) -> Column:
    """Stable bucket in [0, buckets) from the first 32 bits of md5(key).

    Unlike ``randomSplit`` this does not depend on partitioning or row order, so
    the same row lands in the same bucket on every run and on any cluster size.
    """
    return (F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("bigint") % F.lit(buckets)).cast("int")
