"""File readers: raw CSV, curated Parquet, result CSV, prediction batches.

Raw CSV is read as text (header names, no type inference, so no extra pass over
the input) and typed afterwards with ``try_*`` conversions; Spark expands globs
and walks directories itself (``recursiveFileLookup``), so files at any depth
below the given folder are read.
"""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarmac.operators.ingest import arrived, clean
from tarmac.schema import REQUIRED_FOR_TRAINING
from tarmac.sources.snapshots import committed, read_committed


class NoInputError(FileNotFoundError):
    """No readable input at the given location."""


def read_raw_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType | None = None,
    recursive: bool = True,
    glob_filter: str | None = "*.csv",
) -> DataFrame:
    """Headered CSV files as text columns (or with an explicit schema).

    ``path`` may be a folder, a glob or a list of them.  Leading / trailing
    blanks are kept (cleaning trims the codes that need it).  All files must have the
    same header; a file with another one fails the read (``layouts.read_mixed_csv`` takes
    folders of several headers).
    """
    reader = (
        spark.read.option("header", True)
        .option("inferSchema", False)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("mode", "PERMISSIVE")
    )
    if recursive:
        reader = reader.option("recursiveFileLookup", True)
    if glob_filter:
        reader = reader.option("pathGlobFilter", glob_filter)
    if schema is not None:
        reader = reader.schema(schema)
    try:
        df = reader.csv(path)
    except AnalysisException as e:
        raise NoInputError(f"no CSV input at {path}: {e}") from e
    if not df.columns:
        raise NoInputError(f"no CSV input at {path}")
    # bound by position, but every file's header is checked against the columns: a file
    # whose header differs in names or order fails instead of being read into wrong columns
    text = schema or T.StructType([T.StructField(c, T.StringType()) for c in df.columns])
    return reader.schema(text).option("enforceSchema", False).csv(path)


def read_curated(spark: SparkSession, path: str) -> DataFrame:
    """Curated Parquet; year / month come back from the partition folders."""
    return spark.read.parquet(path)


def load_flights(
    spark: SparkSession,
    curated_dir: str | None,
    raw_path: str | list[str] | None = None,
) -> DataFrame:
    """Curated Parquet when readable, else the raw CSV cleaned on the fly.

    Only a missing / unreadable Parquet location falls back; any other error
    propagates.  A one-row probe confirms the curated data is readable.
    """
    if curated_dir:
        try:
            df = read_curated(spark, curated_dir)
            df.limit(1).collect()
            return df
        except AnalysisException:
            pass
    if not raw_path:
        raise NoInputError(f"no curated data at {curated_dir} and no raw input given")
    return arrived(clean(read_raw_csv(spark, raw_path)), REQUIRED_FOR_TRAINING)


def read_result_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """A small result table written by ``sinks.write_result_csv``."""
    reader = spark.read.option("header", True)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    return reader.csv(path)


def read_predictions(spark: SparkSession, path: str, ignore_corrupt: bool = False) -> DataFrame:
    """All committed prediction batches as one table with a ``batch`` column.

    Batches being written are not seen.  A damaged file fails the read unless
    ``ignore_corrupt`` asks to leave its rows out.
    """
    batches = committed(spark, path)
    if not batches:
        raise NoInputError(f"no committed batch at {path}")
    return read_committed(spark, path, batches, ignore_corrupt)


def snapshot_ids(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the committed batches below ``path``, ascending (a folder listing, no data)."""
    return [c.batch for c in committed(spark, path)]


def newest_date(spark: SparkSession, path: str, date_col: str = "flight_date"):
    """The largest date of a Parquet table, answered by its files' footers; None without any.

    The reader of this session pushes the maximum into the scan, which then reads no data
    page.  Where a file has no statistics for the column, the column is scanned.
    """
    own = spark.newSession()
    own.conf.set("spark.sql.sources.useV1SourceList", "avro,csv,json,kafka,orc,text")
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    try:
        return newest_date_query(own, path, date_col).first()[0]
    except (PySparkException, Py4JJavaError):
        return newest_date_query(spark, path, date_col).first()[0]


def newest_date_query(spark: SparkSession, path: str, date_col: str = "flight_date") -> DataFrame:
    return spark.read.parquet(path).agg(F.max(date_col))


def read_recent_months(spark: SparkSession, path: str, months: int, date_col: str = "flight_date") -> DataFrame:
    """The newest ``months`` calendar months of a curated table: their folders only.

    The newest month comes from metadata; the filter is on the partition columns.
    """
    table = read_curated(spark, path)
    newest = newest_date(spark, path, date_col)
    if newest is None:
        return table.where(F.lit(False))
    last = newest.year * 12 + newest.month - 1
    kept = [divmod(k, 12) for k in range(last - months + 1, last + 1)]
    wanted = F.lit(False)
    for year, month in kept:
        wanted = wanted | ((F.col("year") == year) & (F.col("month") == month + 1))
    return table.where(wanted & F.col(date_col).isNotNull())
