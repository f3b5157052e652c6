"""Writers.  Each is one Spark write job; nothing is moved on the driver's disk."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.schema import STREAM_COLUMNS
from tarmac.sources.files import snapshot_ids
from tarmac.sources.snapshots import commit, remove_batch, write_version


def write_curated(
    df: DataFrame,
    path: str,
    partition_by=("year", "month"),
    max_records_per_file: int = 5_000_000,
    only_written: bool = False,
    append: bool = False,
) -> None:
    """Overwrite the curated table, partitioned by year / month.

    A ``rebalance`` on the partition columns is one shuffle that gathers each
    month's rows, so a task writes few folders; adaptive execution splits a month
    that is larger than the advisory partition size (say, one holding a third of
    all rows) into several tasks and merges small months, so files stay near that
    size.  The whole table is replaced, so months that left the source are gone;
    ``only_written`` replaces just the folders that receive rows (incremental loads), and ``append`` keeps all that is there.
    """
    cols = [c for c in partition_by if c in df.columns]
    balanced = df.hint("rebalance", *cols) if cols else df
    writer = (balanced.write.mode("append" if append else "overwrite")
              .option("partitionOverwriteMode", "dynamic" if only_written else "static")
              .option("maxRecordsPerFile", max_records_per_file))
    if cols:
        writer = writer.partitionBy(*cols)
    writer.parquet(path)


def write_result_csv(df: DataFrame, path: str) -> None:
    """A small result table as one headered CSV file in folder ``path``.

    For aggregated results only (a single task writes it).
    """
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def write_replay_files(plan: DataFrame, path: str, columns=STREAM_COLUMNS, compression: str = "none") -> None:
    """One headered CSV (plain or compressed) per replay batch, in folders ``batch_id=N``, in one job.

    Rows are hash-partitioned by batch id first so that a batch is one file (the
    stream's unit of work); batches have a fixed row count, so no task is skewed.
    """
    cols = [c for c in columns if c in plan.columns]
    (plan.select(*cols, "batch_id")
     .repartition("batch_id")
     .write.mode("overwrite")
     .option("header", True)
     .option("compression", compression)
     .partitionBy("batch_id")
     .csv(path))


def write_batch_snapshot(df: DataFrame, path: str, batch_id: int) -> None:
    """Replace batch ``batch_id`` of ``path``; readers see the old rows until the new ones are committed."""
    commit(df.sparkSession, path, write_version(df, path, batch_id))


def drop_old_snapshots(spark: SparkSession, path: str, newest: int, keep: int) -> None:
    """Remove the committed batches older than the ``keep`` newest ones."""
    for batch_id in snapshot_ids(spark, path):
        if batch_id <= newest - keep:
            remove_batch(spark, path, batch_id)


def write_predictions_sample(pred: DataFrame, path: str, limit: int, key_cols, label: str) -> None:
    """The ``limit`` predictions with the smallest key hashes (repeatable), written as one CSV.

    Columns: the key columns, label, prediction and, for classifiers, the
    probability vector as ';'-joined text.
    """
    from tarmac.operators.sampling import bounded_sample

    extra = []
    if "probability" in pred.columns:
        extra = [F.concat_ws(";", vector_to_array("probability").cast("array<string>")).alias("probability")]
    rows = pred.select(*key_cols, label, "prediction", *extra)
    write_result_csv(bounded_sample(rows, limit, list(key_cols)), path)


def save_model(model: PipelineModel, path: str) -> None:
    """Always a full pipeline (indexers, encoder, assembler, estimator)."""
    model.write().overwrite().save(path)


def append_metrics(metrics: DataFrame, path: str) -> None:
    """Append one run's metrics row to the log table."""
    metrics.write.mode("append").parquet(path)
