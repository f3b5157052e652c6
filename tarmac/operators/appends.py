"""Loads that add to a curated table only what it does not hold yet (duplicates across loads).

Every row carries a digest of its columns, stored beside them.  A new load is compared with the
digests of those months alone that it touches: other months' folders are not listed, and of the
touched ones only the digest column is read.  A membership filter per month (a bitmap of digest
positions) passes most new rows by: what the filter lacks is certainly new and is not shuffled; the
rest goes through an exact anti-join on the digests.  A table whose rows have no digests gets them computed
from its columns; the rows of one table must all have them or all lack them.

The filter is broadcast only while the touched months' bitmaps stay within ``FILTER_BYTES``; beyond
that every row of a month that has rows takes the anti-join, with the same result.  Digests are spread
evenly, so no key of the join is hot, whatever the months' sizes.

Defined results: a load that repeats rows adds each once; a table that does not exist yet is empty; an
empty load changes nothing; NULLs equal NULLs; rows without a month (no flight date) are compared with
the table's rows without one.  Loads of one table are made one after the other.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarmac.operators.partials import PARTITIONS, Month, refresh_states
from tarmac.session import list_folder, remove_folder, work_dir
from tarmac.sinks.writers import write_curated

DIGEST = "row_digest"
# Bits of one month's filter, and the bytes that all filters of a load may take together.
FILTER_BITS = 1 << 22
FILTER_BYTES = 64 << 20
# Bits of one bitmap of ``bitmap_construct_agg`` (fixed by Spark).
BITMAP_BITS = 32768


@dataclass(frozen=True)
class Appended:
    """What a load did: rows delivered, rows added, and the months that got some."""

    delivered: int
    added: int
    months: tuple[Month, ...]

    @property
    def known(self) -> int:
        """Rows that the table held already, or that the load repeated."""
        return self.delivered - self.added


def row_digest(df: DataFrame) -> Column:
    """MD5 of a row's columns in the order of their names; the digest itself is left out.

    Rows that ``dropDuplicates`` takes for equal have equal digests: zeros lose their sign.
    """
    fields = []
    for f in sorted((f for f in df.schema.fields if f.name != DIGEST), key=lambda f: f.name):
        c = F.col(f"`{f.name}`")
        fields.append((c + F.lit(0).cast(f.dataType) if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else c).alias(f.name))
    return F.unhex(F.md5(F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})))


def with_digest(df: DataFrame) -> DataFrame:
    """``df`` with its digest column; one that is there is kept."""
    return df if DIGEST in df.columns else df.withColumn(DIGEST, row_digest(df))


def held_digests(spark: SparkSession, curated_path: str, months: Sequence[tuple]) -> DataFrame | None:
    """(year, month, digest) of the table's rows in ``months``, whose folders alone are listed; None without a table.

    A table that was written without digests gets them computed from its columns.
    """
    if not any(n.startswith("year=") for n in list_folder(spark, curated_path)):
        return None
    return with_digest(spark.read.parquet(curated_path)).where(months_filter(months)).select(*PARTITIONS, DIGEST)


def months_filter(months) -> Column:
    """A filter on the partition columns for these months; a month may be unknown (NULL)."""
    chosen = F.lit(False)
    for year, month in months:
        each = [F.col(c).isNull() if v is None else F.col(c) == v for c, v in zip(PARTITIONS, (year, month))]
        chosen = chosen | (each[0] & each[1])
    return chosen


def _position(digest: Column, bits: int) -> Column:
    return F.pmod(F.xxhash64(digest), F.lit(bits))


def membership(held: DataFrame, bits: int = FILTER_BITS) -> DataFrame:
    """(year, month, part, bitmap): the digests' positions among ``bits``; parts without a digest are absent."""
    at = held.select(*PARTITIONS, _position(F.col(DIGEST), bits).alias("_at"))
    parts = at.groupBy(*PARTITIONS, F.floor(F.col("_at") / BITMAP_BITS).cast("int").alias("part"))
    return parts.agg(F.bitmap_construct_agg(F.col("_at") % BITMAP_BITS).alias("bitmap"))


def _bit(bitmap: Column, at: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bitmap, F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return byte.bitwiseAND(F.pow(F.lit(2), at % 8).cast("int")) != 0


def split_by_filter(load: DataFrame, filters: DataFrame, bits: int = FILTER_BITS) -> DataFrame:
    """``load`` with ``_maybe``: whether the filter of the row's month holds its digest.  No row is shuffled."""
    placed = load.withColumn("_at", _position(F.col(DIGEST), bits)).withColumn("_part", F.floor(F.col("_at") / BITMAP_BITS).cast("int"))
    known = filters.select(F.col("year").alias("_y"), F.col("month").alias("_m"), F.col("part").alias("_p"), "bitmap")
    same = F.col("year").eqNullSafe(F.col("_y")) & F.col("month").eqNullSafe(F.col("_m")) & (F.col("_part") == F.col("_p"))
    joined = placed.join(F.broadcast(known), same, "left")
    maybe = F.coalesce(_bit(F.col("bitmap"), F.col("_at") % BITMAP_BITS), F.lit(False))
    return joined.withColumn("_maybe", maybe).drop("_y", "_m", "_p", "_at", "_part", "bitmap")


def unseen(load: DataFrame, held: DataFrame, months: int, bits: int = FILTER_BITS) -> DataFrame:
    """The rows of ``load`` (with digests) that are not among ``held``, exactly.

    ``months`` is the number of months that the load touches: it decides whether their filters are small
    enough to be broadcast.
    """
    keys = held.select(F.col(DIGEST).alias("_digest"), F.col("year").alias("_year"), F.col("month").alias("_month"))
    same = (F.col(DIGEST) == F.col("_digest")) & F.col("year").eqNullSafe(F.col("_year")) & F.col("month").eqNullSafe(F.col("_month"))
    if months * bits // 8 > FILTER_BYTES:
        return load.join(keys, same, "left_anti")
    tagged = split_by_filter(load, membership(held, bits), bits)
    new = tagged.where(~F.col("_maybe")).drop("_maybe")
    return new.unionByName(tagged.where("_maybe").drop("_maybe").join(keys, same, "left_anti"))


def append_new(df: DataFrame, curated_path: str, bits: int = FILTER_BITS) -> Appended:
    """Add the rows of ``df`` that the curated table lacks; returns what was done.

    The load's distinct rows are written to the work folder once, so its files are read a single time; the
    table gets one append, which shows as a whole when its job commits.
    """
    spark = df.sparkSession
    staged, chosen = work_dir(spark, "append"), work_dir(spark, "append_new")
    try:
        # copies within the load collapse before the shuffle; the digest, which follows from the other columns, is added behind it
        copies = df.groupBy(*[F.col(f"`{c}`") for c in df.columns]).agg(F.count(F.lit(1)).alias("_copies"))
        if DIGEST not in df.columns:
            copies = copies.withColumn(DIGEST, row_digest(df))
        copies.write.parquet(staged)
        load = spark.read.schema(copies.schema).parquet(staged)
        per_month = load.groupBy(*PARTITIONS).agg(F.sum("_copies").alias("n")).collect()  # one row per month
        load = load.drop("_copies")
        held = held_digests(spark, curated_path, [(r["year"], r["month"]) for r in per_month])
        if held is not None:
            load = unseen(load, held, len(per_month), bits)
            if DIGEST not in spark.read.parquet(curated_path).columns:
                load = load.drop(DIGEST)
            load.write.parquet(chosen)
            load = spark.read.schema(load.schema).parquet(chosen)
        new = load  # without a table, all staged rows
        added = new.groupBy(*PARTITIONS).agg(F.count(F.lit(1)).alias("n")).collect()
        if added:
            write_curated(new, curated_path, append=True)
    finally:
        remove_folder(spark, staged)
        remove_folder(spark, chosen)
    months = sorted((r["year"], r["month"]) for r in added if r["year"] is not None and r["month"] is not None)
    return Appended(sum(r["n"] for r in per_month), sum(r["n"] for r in added), tuple(months))


def append_months(df: DataFrame, curated_path: str, state_path: str, bits: int = FILTER_BITS) -> Appended:
    """``append_new``, and the summary states of the months that got rows refreshed."""
    done = append_new(df, curated_path, bits)
    refresh_states(df.sparkSession, curated_path, state_path, done.months)
    return done
