"""Rows that cleaning cannot use, kept with their reasons instead of vanishing.

``tag_rejects`` adds the array ``reject_reasons`` to raw text rows; ``accepted`` and ``rejected``
split on it, so every delivered row is in exactly one of the two.  All of it is column
expressions over one scan.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.functions.columns import parse_date_multi, to_double
from tarmac.operators.ingest import add_derived, dedup_rows, normalise, rename_headers
from tarmac.schema import MEASURES, STRING_KEYS
from tarmac.sinks.writers import write_curated
from tarmac.sources.layouts import CORRUPT, FIELDS

REASONS = "reject_reasons"
# What a feed writes for "no value"; these are missing, not unreadable.
MISSING = ("", "NA", "NaN", "null")
# Columns without which a row cannot be placed in the curated table.
REQUIRED = ("flight_date", "airline", "origin", "dest")


def _blank(c: Column) -> Column:
    return c.isNull() | F.trim(c).isin(*MISSING)


def field_count(record: Column, sep: str = ",") -> Column:
    """Fields of a delimited record, separators inside quotes not counted."""
    bare = F.regexp_replace(record, r'"(?:[^"]|"")*"', "")
    return F.length(bare) - F.length(F.replace(bare, F.lit(sep), F.lit(""))) + 1


def reject_reasons(df: DataFrame, required: Iterable[str] = REQUIRED) -> Column:
    """The reasons to reject a raw row (canonical names, text columns), in a fixed order.

    ``fields_missing`` / ``fields_extra``: the record has not as many fields as its header;
    ``bad_<column>``: text that is no date or number; ``no_<column>``: a required column without a value.
    """
    found = []
    if CORRUPT in df.columns:
        broken = F.col(CORRUPT).isNotNull()
        found.append(F.when(broken & (field_count(F.col(CORRUPT)) < F.col(FIELDS)), F.lit("fields_missing")))
        found.append(F.when(broken & (field_count(F.col(CORRUPT)) >= F.col(FIELDS)), F.lit("fields_extra")))
    columns = {c: F.col(f"`{c}`").cast("string") for c in df.columns}
    if "flight_date" in columns:
        text = columns["flight_date"]
        found.append(F.when(~_blank(text) & parse_date_multi("flight_date").isNull(), F.lit("bad_flight_date")))
    for c in (*MEASURES, "crs_dep_time"):
        if c in columns:
            found.append(F.when(~_blank(columns[c]) & to_double(c).isNull(), F.lit(f"bad_{c}")))
    for c in required:
        missing = _blank(columns[c]) if c in columns else F.lit(True)
        found.append(F.when(missing, F.lit(f"no_{c}")))
    return F.array_compact(F.array(*found))


def tag_rejects(raw: DataFrame, required: Iterable[str] = REQUIRED) -> DataFrame:
    named = rename_headers(raw)
    return named.withColumn(REASONS, reject_reasons(named, required))


def accepted(tagged: DataFrame) -> DataFrame:
    """Raw rows without a reason, ready for ``clean``."""
    return tagged.where(F.size(REASONS) == 0).drop(REASONS, CORRUPT, FIELDS)


def rejected(tagged: DataFrame) -> DataFrame:
    """Raw rows with their reasons, as they came."""
    return tagged.where(F.size(REASONS) > 0)


def counts_by_reason(tagged: DataFrame) -> DataFrame:
    """(reason, n): a row with several reasons counts under its first; ``accepted`` and ``delivered`` are rows of their own."""
    first = F.coalesce(F.get(F.col(REASONS), F.lit(0)), F.lit("accepted"))
    rolled = tagged.rollup(first.alias("reason")).agg(F.count(F.lit(1)).alias("n"))
    return rolled.select(F.coalesce("reason", F.lit("delivered")).alias("reason"), "n")


def load_with_rejects(raw: DataFrame, curated_path: str, rejects_path: str, columns: Iterable[str]) -> dict[str, int]:
    """Write the curated table and, beside it, the rejected rows; returns the counts.

    ``delivered`` = ``rejected`` + ``duplicates`` + ``curated``.  The raw files are read once: the tagged rows are
    kept on the executors until both tables are written.
    """
    tagged = tag_rejects(raw).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        rejected(tagged).write.mode("overwrite").parquet(rejects_path)
        rows = add_derived(dedup_rows(normalise(accepted(tagged))))
        write_curated(rows.select(*[c for c in columns if c in rows.columns]), curated_path)
        delivered, bad = tagged.agg(F.count(F.lit(1)), F.count_if(F.size(REASONS) > 0)).first()
    finally:
        tagged.unpersist()
    curated = raw.sparkSession.read.parquet(curated_path).count()
    return {"delivered": delivered, "rejected": bad, "duplicates": delivered - bad - curated, "curated": curated}
