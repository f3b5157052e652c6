"""Committed ``batch=N`` folders.

A batch's rows are written to a folder of their own, ``batch=N/version=<id>``, and count only once a
marker file ``_commits/batch=N@<sequence>@<id>`` exists; creating it is one atomic file operation.  A
rewritten batch gets a new version and a higher sequence: readers go on with the old one until
the new marker is there.  A writer that dies leaves rows that no reader sees, and the next write of that
batch removes them, together with versions older than the one that it replaced (that one stays, for readers who have
already listed it).
"""

from __future__ import annotations

import uuid
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

from tarmac.session import create_marker, list_folder, remove_folder

COMMITS = "_commits"


class Committed(NamedTuple):
    batch: int
    sequence: int
    version: str

    @property
    def marker(self) -> str:
        return f"batch={self.batch}@{self.sequence}@{self.version}"

    def folder(self, path: str) -> str:
        return f"{path.rstrip('/')}/batch={self.batch}/version={self.version}"


def parse_marker(name: str) -> Committed | None:
    parts = name.split("@")
    if len(parts) != 3 or not parts[0].startswith("batch=") or not parts[0][6:].isdigit() or not parts[1].isdigit():
        return None
    return Committed(int(parts[0][6:]), int(parts[1]), parts[2])


def all_commits(spark: SparkSession, path: str) -> list[Committed]:
    """Every marker below ``path``, by batch and sequence."""
    return sorted(c for c in map(parse_marker, list_folder(spark, f"{path.rstrip('/')}/{COMMITS}")) if c)


def committed(spark: SparkSession, path: str) -> list[Committed]:
    """The current version of every committed batch, by batch (a listing, no data)."""
    return list({c.batch: c for c in all_commits(spark, path)}.values())


def write_version(df: DataFrame, path: str, batch_id: int) -> Committed:
    """Write a batch's rows where no reader looks yet."""
    before = [c for c in all_commits(df.sparkSession, path) if c.batch == batch_id]
    new = Committed(batch_id, 1 + max([c.sequence for c in before], default=0), uuid.uuid4().hex[:12])
    df.write.parquet(new.folder(path))
    return new


def commit(spark: SparkSession, path: str, new: Committed) -> None:
    """Make a written version the batch's current one, then clear what nobody can be reading."""
    create_marker(spark, f"{path.rstrip('/')}/{COMMITS}/{new.marker}")
    own = [c for c in all_commits(spark, path) if c.batch == new.batch]
    kept = {c.version for c in own[-2:]}
    for old in own[:-2]:
        remove_folder(spark, f"{path.rstrip('/')}/{COMMITS}/{old.marker}")
    for name in list_folder(spark, f"{path.rstrip('/')}/batch={new.batch}"):
        if name.startswith("version=") and name[8:] not in kept:
            remove_folder(spark, f"{path.rstrip('/')}/batch={new.batch}/{name}")


def remove_batch(spark: SparkSession, path: str, batch_id: int) -> None:
    """Drop a batch: its markers first, so no reader starts on rows that go away."""
    for c in all_commits(spark, path):
        if c.batch == batch_id:
            remove_folder(spark, f"{path.rstrip('/')}/{COMMITS}/{c.marker}")
    remove_folder(spark, f"{path.rstrip('/')}/batch={batch_id}")


def read_committed(spark: SparkSession, path: str, batches: list[Committed], ignore_corrupt: bool = False) -> DataFrame:
    """Rows of some committed batches as one table with a ``batch`` column."""
    folders = [c.folder(path) for c in batches]
    reader = spark.read.option("ignoreCorruptFiles", ignore_corrupt).option("basePath", path)
    return reader.parquet(*folders).drop("version")
