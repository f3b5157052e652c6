"""Raw CSV folders whose files differ in header.

Files of one delivery may name, order or leave out columns differently.  The header of every
file is read in one distributed pass (a task opens one split and stops after its
first lines), files of equal header form a group, each group is read by its own names and
renamed to the canonical ones, and the groups are united by name.  The driver sees one row per
file, like Spark's own file listing.
"""

from __future__ import annotations

import csv
from collections.abc import Iterable
from urllib.parse import unquote

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarmac.operators.ingest import header_renames
from tarmac.schema import RENAME_MAP
from tarmac.sources.files import NoInputError

CORRUPT = "_corrupt_record"
FIELDS = "_n_fields"
# Distinct headers of one delivery; more point to files that have none.
MAX_LAYOUTS = 256
_HEADER_ROWS = 8


def _text_session(spark: SparkSession) -> SparkSession:
    """A session in which every file split is a task of its own and batches are a few lines."""
    own = spark.newSession()
    own.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    own.conf.set("spark.sql.files.openCostInBytes", str(1 << 40))
    own.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(_HEADER_ROWS))
    return own


def file_headers(spark: SparkSession, path: str | list[str], recursive: bool = True, glob_filter: str | None = "*.csv") -> DataFrame:
    """(file, header): the first line of every file that has one."""
    reader = _text_session(spark).read
    if recursive:
        reader = reader.option("recursiveFileLookup", True)
    if glob_filter:
        reader = reader.option("pathGlobFilter", glob_filter)
    try:
        lines = reader.text(path)
    except AnalysisException as e:
        raise NoInputError(f"no CSV input at {path}: {e}") from e

    def first(batches: Iterable[pa.RecordBatch]):
        seen = None
        for batch in batches:
            files, starts, values = (batch.column(k).to_pylist() for k in range(3))
            for file, start, value in zip(files, starts, values):
                if file != seen and start == 0:
                    yield pa.RecordBatch.from_arrays([pa.array([file], pa.string()), pa.array([value], pa.string())], names=["file", "header"])
                seen = file
            if len(set(files)) == 1:
                return  # one split is one task: nothing else follows

    named = lines.select("_metadata.file_path", "_metadata.file_block_start", "value")
    return named.mapInArrow(first, "file string, header string")


def header_names(line: str) -> list[str]:
    """Column names of a header line; blank and repeated names get helper names that start with ``_``."""
    names: list[str] = []
    for k, cell in enumerate(next(csv.reader([line.lstrip("﻿").rstrip("\r")]), [])):
        name = cell.strip()
        names.append(name if name and name.lower() not in {n.lower() for n in names} else f"_unnamed_{k}")
    return names


def read_mixed_csv(
    spark: SparkSession,
    path: str | list[str],
    recursive: bool = True,
    glob_filter: str | None = "*.csv",
    mapping=RENAME_MAP,
    corrupt: bool = False,
    max_layouts: int = MAX_LAYOUTS,
) -> DataFrame:
    """All files as text columns under canonical names, whatever their headers.

    A column that a file lacks is NULL there; files without any line are skipped.  With ``corrupt``,
    records with too few or too many fields keep their text in ``_corrupt_record``
    and every row its header's field count in ``_n_fields``.
    """
    found = file_headers(spark, path, recursive, glob_filter)
    groups = found.groupBy("header").agg(F.sort_array(F.collect_list("file")).alias("files")).orderBy("header").limit(max_layouts + 1).collect()
    if not groups:
        raise NoInputError(f"no CSV input with a header at {path}")
    if len(groups) > max_layouts:
        raise ValueError(f"more than {max_layouts} different headers at {path}: do the files have any?")
    united = None
    for group in groups:
        names = header_names(group["header"])
        fields = [T.StructField(n, T.StringType()) for n in names]
        if corrupt:
            fields.append(T.StructField(CORRUPT, T.StringType()))
        part = (
            spark.read.option("header", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
            .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
            .option("columnPruning", not corrupt)  # a pruned record's fields are not counted
            .schema(T.StructType(fields)).csv([unquote(f) for f in group["files"]])
        )
        renames = header_renames(names, mapping)
        kept = [F.col(f"`{n}`").alias(renames.get(n, n)) for n in names if not n.startswith("_unnamed_")]
        if corrupt:
            kept += [F.col(CORRUPT), F.lit(len(names)).alias(FIELDS)]
        part = part.select(*kept)
        united = part if united is None else united.unionByName(part, allowMissingColumns=True)
    return united
