"""Session construction and the shared working folder.

Jobs that must write intermediate data (replay files, model directories,
stream checkpoints, lineage cuts) write below the folder the cluster names in
``spark.checkpoint.dir``.  A machine-local temporary folder is used only when the
session has none configured and its master is a single local process (tests, a
laptop); on a cluster a missing setting is an error.
"""

from __future__ import annotations

import tempfile
import uuid
from collections import OrderedDict
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every session gets: adaptive execution re-plans joins and shuffle
# partition counts from runtime statistics and splits skewed join partitions.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.showConsoleProgress": "false",
    # remove reliable-checkpoint files once their DataFrame is garbage collected
    # (takes effect only when the context is created with it)
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(
    master: str | None = None,
    app_name: str = "tarmac",
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the engine's base settings."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in BASE_CONF.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra_conf or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_root(spark)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """Return the session's reliable checkpoint folder, configuring one if unset.

    The cluster's ``spark.checkpoint.dir`` wins; only when it is missing on a
    ``local`` master a fresh temporary folder is registered.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError(
                "spark.checkpoint.dir is not set: name a folder that the driver and all executors share"
            )
        configured = tempfile.mkdtemp(prefix="tarmac-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder (path string) below the shared checkpoint root."""
    return f"{checkpoint_root(spark).rstrip('/')}/tarmac/{name}-{uuid.uuid4().hex[:12]}"


def _path(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsc.hadoopConfiguration())


def remove_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder that the engine wrote."""
    target, fs = _path(spark, path)
    fs.delete(target, True)


def make_folder(spark: SparkSession, path: str) -> None:
    """Create a folder unless it is there."""
    target, fs = _path(spark, path)
    fs.mkdirs(target)


def create_marker(spark: SparkSession, path: str) -> None:
    """Create a file that must not exist yet: one atomic operation of the file system."""
    target, fs = _path(spark, path)
    out = fs.create(target, False)
    out.writeBytes("1")
    out.close()


def list_folder(spark: SparkSession, path: str) -> list[str]:
    """Names directly below a folder; none when it does not exist."""
    target, fs = _path(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(target)] if fs.exists(target) else []


def input_state(spark: SparkSession, folder: str) -> tuple:
    """Name, size and time of everything directly below a folder: changes when the data do."""
    target, fs = _path(spark, folder)
    return tuple(sorted((s.getPath().getName(), s.getLen(), s.getModificationTime()) for s in fs.listStatus(target)))


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Jobs started in this block remove their shuffle files when they end, not when the driver collects its garbage.

    For writes whose plan is not run again.
    """
    before = spark.conf.get(SHUFFLE_CLEANUP)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)


class Fixtures:
    """Results that several queries of a session share, remade when their input changes.

    A result is looked up by session, input folder, the state of the files there and a
    name; the oldest ones beyond ``keep`` are handed to their clean-up.
    """

    def __init__(self, keep: int):
        self.keep, self.made = keep, OrderedDict()

    def get(self, spark: SparkSession, folder: str, name, make, clean_up):
        key = (spark.sparkContext.applicationId, folder, input_state(spark, folder), name)
        if key not in self.made:
            self.made[key] = (make(), clean_up)
        self.made.move_to_end(key)
        result = self.made[key][0]
        while len(self.made) > self.keep:
            (app, *_), (old, clean) = self.made.popitem(last=False)
            if app == spark.sparkContext.applicationId:
                clean(spark, old)
        return result
