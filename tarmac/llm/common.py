"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import string
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.session import checkpoint_root, work_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage: written to the shared checkpoint folder, read back from there."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame) -> tuple[DataFrame, str]:
    """Cut the lineage through a Parquet table in the shared folder: (table read back, its path).

    Unlike a checkpoint it has statistics of its own, so loops do not pile up estimates.
    """
    path = work_dir(df.sparkSession, "table")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def removed(spark: SparkSession, paths: Iterable[str]) -> None:
    """Delete tables that ``written`` made."""
    for path in paths:
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def text_or_empty(column: str | Column) -> Column:
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only; every other character stays."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id's decimal text modulo ``folds``; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds


def packed_rows(df: DataFrame, *derived: Column) -> DataFrame:
    """The whole row as one struct ``_row`` beside derived columns.

    Derived names then cannot clash with whatever columns the caller's table has.
    """
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row"), *derived)


def unpacked_rows(df: DataFrame) -> DataFrame:
    return df.select("_row.*")
