"""Structured Streaming over replayed flight files.

* ``read_replay_stream``   file source with a fixed positional schema and a
                           files-per-trigger rate limit.
* ``normalise_stream``     the batch cleaning steps applied to a stream.
* ``running_avg_by_airline`` complete-mode running average per airline; state is
                           one row per airline (bounded by the number of
                           airlines, not by time).
* ``run_snapshots``        ``foreachBatch`` writes each complete result to
                           ``batch=<id>`` and commits it (a replayed micro-batch
                           replaces its own rows, so the sink is idempotent).
* ``run_scoring``          stateless per-micro-batch model scoring, empty batches
                           skipped, predictions appended as ``batch=<id>``; rows
                           that cannot be scored stay with NULL outputs.
* ``latest_snapshot``      newest committed batch of a snapshot folder, found by listing;
                           one folder is read.
* ``run_live_tables``      a second stream, over the commits of a prediction folder:
                           per-airline sums of each batch, read once.

Triggers: ``availableNow`` drains what is there in rate-limited micro-batches
and stops (tests, backfills), without any time limit; a processing-time interval runs
continuously.  The rate is the caller's: files or bytes per trigger.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from urllib.parse import unquote

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tarmac.functions.columns import parse_date_multi, to_double
from tarmac.operators.ingest import coalesce_spellings, drop_null_required, fill_missing_derived
from tarmac.schema import REQUIRED_FOR_STREAM, STREAM_SCHEMA
from tarmac.sinks.writers import drop_old_snapshots, write_batch_snapshot
from tarmac.session import make_folder
from tarmac.sources.files import NoInputError
from tarmac.sources.snapshots import COMMITS, committed, parse_marker, read_committed


REPLAY_FILES = "{*.csv,*.csv.gz,*.csv.lz4}"


def read_replay_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType = STREAM_SCHEMA,
    max_files_per_trigger: int | None = 1,
    max_bytes_per_trigger: str | None = None,
) -> DataFrame:
    """CSV files below ``path`` (any depth, plain or compressed), bound by position to ``schema``.

    The rate is either a number of files or, with ``max_bytes_per_trigger``, a size.
    """
    rate = ({"maxBytesPerTrigger": max_bytes_per_trigger} if max_bytes_per_trigger
            else {"maxFilesPerTrigger": max_files_per_trigger} if max_files_per_trigger else {})
    return (
        spark.readStream.schema(schema)
        .option("header", True)
        .options(**rate)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", REPLAY_FILES)
        .csv(path)
    )


def read_table_stream(
    spark: SparkSession,
    folder: str,
    file_glob: str,
    schema: T.StructType,
    max_files_per_trigger: int = 1,
) -> DataFrame:
    """Parquet files of one table in ``folder`` (those matching ``file_glob``) as a stream."""
    return (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", max_files_per_trigger)
        .option("pathGlobFilter", file_glob)
        .parquet(folder)
    )


def normalise_stream(stream: DataFrame) -> DataFrame:
    """Date text -> date, missing derived columns filled, codes trimmed, unusable rows dropped."""
    out = coalesce_spellings(stream, "arr_delay", ["ARR_DELAY"])
    if "flight_date" in out.columns and isinstance(out.schema["flight_date"].dataType, T.StringType):
        out = out.withColumn("flight_date", parse_date_multi(F.trim("flight_date")))
    if "flight_date" in out.columns:
        out = fill_missing_derived(out)
    trims = {c: F.trim(F.col(c)) for c in ("airline", "origin", "dest") if c in out.columns}
    out = out.withColumns(trims)
    if "arr_delay" in out.columns:
        out = out.withColumn("arr_delay", to_double("arr_delay"))
    return drop_null_required(out, REQUIRED_FOR_STREAM)


def running_avg_by_airline(stream: DataFrame) -> DataFrame:
    return stream.groupBy("airline").agg(
        F.avg("arr_delay").alias("avg_arr_delay"),
        F.count(F.lit(1)).alias("n"),
    )


def _trigger(writer, available_now: bool, processing_time: str):
    return writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=processing_time)


def _finish(query: StreamingQuery, available_now: bool) -> StreamingQuery:
    """A drain ends when everything that was there is processed, however long that takes."""
    if available_now:
        query.awaitTermination()
        if query.exception() is not None:
            raise RuntimeError(f"streaming query failed: {query.exception()}")
    return query


def state_session(spark: SparkSession, state_partitions: int = 4) -> SparkSession:
    """A session of its own for a stream, with that many state partitions.

    The count is fixed in a stream's checkpoint at its first start.  Keys that are few
    (one per airline) are partially aggregated before the shuffle, so a handful of state
    partitions serves any input volume; each one costs a commit per micro-batch.  The
    caller's session is left as it is.
    """
    own = spark.newSession()
    own.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    own.conf.set("spark.sql.shuffle.partitions", str(state_partitions))
    return own


def run_snapshots(
    agg: DataFrame,
    out_dir: str,
    checkpoint_dir: str,
    available_now: bool = True,
    processing_time: str = "10 seconds",
    keep: int | None = None,
) -> StreamingQuery:
    """Complete-mode aggregate -> one Parquet snapshot folder per micro-batch.

    ``keep`` retains only that many newest snapshots.  Build the stream on a
    ``state_session`` to choose its state partitions.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        # the complete result is one row per group (bounded): one file per snapshot
        write_batch_snapshot(batch.coalesce(1), out_dir, batch_id)
        if keep:
            drop_old_snapshots(batch.sparkSession, out_dir, batch_id, keep)

    writer = (agg.writeStream.outputMode("complete")
              .option("checkpointLocation", checkpoint_dir)
              .foreachBatch(write))
    return _finish(_trigger(writer, available_now, processing_time).start(), available_now)


def run_append(
    stream: DataFrame,
    out_dir: str,
    checkpoint_dir: str,
    available_now: bool = True,
    processing_time: str = "10 seconds",
) -> StreamingQuery:
    """Append a (stateless) stream to a Parquet folder with the exactly-once file sink."""
    writer = (stream.writeStream.outputMode("append").format("parquet")
              .option("checkpointLocation", checkpoint_dir).option("path", out_dir))
    return _finish(_trigger(writer, available_now, processing_time).start(), available_now)


def raw_inputs(model: PipelineModel) -> list[str]:
    """Columns that the model's assemblers take as they come, not from an earlier stage."""
    made, taken = set(), []
    for stage in model.stages:
        if isinstance(stage, VectorAssembler):
            taken += [c for c in stage.getInputCols() if c not in made]
        for name in ("outputCol", "outputCols"):
            if stage.hasParam(name) and stage.isDefined(name):
                value = stage.getOrDefault(name)
                made.update([value] if isinstance(value, str) else value)
    return list(dict.fromkeys(taken))


# --- fixed values: what consumers of the scored flights read ---
FLIGHT_SCORES = {"pred_delayed": "prediction", "pred_prob_vec": "probability", "p_delayed": ("probability", 1)}


def _output(source: str | tuple[str, int]) -> Column:
    """A model column, or one slot of a vector column."""
    return F.col(source) if isinstance(source, str) else vector_to_array(source[0])[source[1]]


def score_rows(model: PipelineModel, rows: DataFrame, outputs: Mapping[str, str | tuple[str, int]],
               keep: Sequence[str] | None = None) -> DataFrame:
    """Rows with a model's outputs; ``keep`` names the columns that pass through (default: all).

    A row that lacks a numeric input cannot be scored: it stays, with NULL outputs.  One
    bad value therefore never fails a micro-batch (and with it every retry).
    """
    passed = [F.col(f"`{c}`") for c in (keep if keep is not None else rows.columns)]
    complete = F.lit(True)
    for c in raw_inputs(model):
        complete = complete & F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double"))
    scored = model.transform(rows.where(complete)).select(*passed, *[_output(e).alias(n) for n, e in outputs.items()])
    kinds = {n: scored.schema[n].dataType for n in outputs}
    rest = rows.where(~complete).select(*passed, *[F.lit(None).cast(k).alias(n) for n, k in kinds.items()])
    return scored.unionByName(rest)


def run_scoring(
    stream: DataFrame,
    model: PipelineModel,
    out_dir: str,
    checkpoint_dir: str,
    available_now: bool = True,
    processing_time: str = "10 seconds",
    outputs: Mapping[str, str | tuple[str, int]] = FLIGHT_SCORES,
    keep: Sequence[str] | None = None,
) -> StreamingQuery:
    """Score every micro-batch into ``batch=<id>``; empty ones are skipped."""

    def write(batch: DataFrame, batch_id: int) -> None:
        # its files are read and parsed once; scorable and other rows are two passes over the parsed rows
        batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            if not batch.isEmpty():
                write_batch_snapshot(score_rows(model, batch, outputs, keep), out_dir, batch_id)
        finally:
            batch.unpersist()

    writer = (stream.writeStream.outputMode("append")
              .option("checkpointLocation", checkpoint_dir)
              .foreachBatch(write))
    return _finish(_trigger(writer, available_now, processing_time).start(), available_now)


def latest_snapshot(spark: SparkSession, out_dir: str) -> DataFrame:
    """Rows of the newest committed batch (the current complete result).

    The newest number comes from the listing of commits; only its folder is read.
    """
    batches = committed(spark, out_dir)
    if not batches:
        raise NoInputError(f"no snapshot at {out_dir}")
    return read_committed(spark, out_dir, batches[-1:]).withColumn("batch", F.lit(batches[-1].batch))


# --- live tables, kept up to date by a stream over the commits of a prediction folder ---

# fixed: the columns of Spark's binary file source
_MARKER_FILE = "path string, modificationTime timestamp, length long, content binary"
LIVE_PARTIAL = ("airline", "n", "n_delay", "sum_delay", "n_pred", "sum_pred", "n_prob", "sum_prob")


def live_partial(predictions: DataFrame) -> DataFrame:
    """Counts and sums per airline from which both live tables follow; those of disjoint rows add up."""
    def pair(name: str, c: str):
        return [F.count(c).alias(f"n_{name}"), F.sum(c).alias(f"sum_{name}")]

    return predictions.groupBy("airline").agg(
        F.count(F.lit(1)).alias("n"), *pair("delay", "arr_delay"), *pair("pred", "pred_delayed"), *pair("prob", "p_delayed"))


def run_live_tables(
    spark: SparkSession,
    predictions_dir: str,
    state_dir: str,
    checkpoint_dir: str,
    available_now: bool = True,
    processing_time: str = "10 seconds",
    commits_per_trigger: int = 1000,
) -> StreamingQuery:
    """Follow a prediction folder: each newly committed batch is read once and reduced to one row per airline.

    The stream's source is the folder of commit markers, so batches still being written are never
    read, and a batch that is committed anew replaces its own contribution (state batch N
    stands for prediction batch N).  Running it twice on a marker gives the same state.
    """
    folder = f"{predictions_dir.rstrip('/')}/{COMMITS}"
    make_folder(spark, folder)  # the stream may start before the first commit
    markers = (spark.readStream.format("binaryFile").schema(_MARKER_FILE).option("maxFilesPerTrigger", commits_per_trigger)
               .option("pathGlobFilter", "batch=*").option("ignoreMissingFiles", True).load(folder).select("path"))

    def write(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        named = {parse_marker(unquote(r["path"]).rsplit("/", 1)[-1]) for r in batch.collect()}  # at most commits_per_trigger names
        current = {c.batch: c for c in committed(session, predictions_dir)}
        for batch_number in sorted({c.batch for c in named if c} & set(current)):
            rows = read_committed(session, predictions_dir, [current[batch_number]])
            # one row per airline
            write_batch_snapshot(live_partial(rows).coalesce(1), state_dir, batch_number)

    writer = markers.writeStream.option("checkpointLocation", checkpoint_dir).foreachBatch(write)
    return _finish(_trigger(writer, available_now, processing_time).start(), available_now)


def _live_totals(spark: SparkSession, state_dir: str) -> DataFrame:
    batches = committed(spark, state_dir)
    if not batches:
        raise NoInputError(f"no live state at {state_dir}")
    rows = read_committed(spark, state_dir, batches)
    return rows.groupBy("airline").agg(*[F.sum(c).alias(c) for c in LIVE_PARTIAL[1:]])


def _mean(name: str) -> Column:
    return F.when(F.col(f"n_{name}") > 0, F.col(f"sum_{name}") / F.col(f"n_{name}"))


def live_delay_from_state(spark: SparkSession, state_dir: str) -> DataFrame:
    """``live_delay_by_airline`` from the followed state: no prediction is read."""
    return (_live_totals(spark, state_dir).select("airline", _mean("delay").alias("avg_arr_delay"), "n")
            .orderBy("avg_arr_delay", "airline"))


def live_rate_from_state(spark: SparkSession, state_dir: str) -> DataFrame:
    """``live_predicted_rate`` from the followed state: no prediction is read."""
    return (_live_totals(spark, state_dir)
            .select("airline", _mean("pred").alias("predicted_delayed_rate"), _mean("prob").alias("mean_delay_probability"), "n")
            .orderBy("predicted_delayed_rate", "airline"))


def live_delay_by_airline(predictions: DataFrame) -> DataFrame:
    """Mean actual delay per airline over all scored batches, ascending."""
    return (predictions.groupBy("airline")
            .agg(F.avg("arr_delay").alias("avg_arr_delay"), F.count(F.lit(1)).alias("n"))
            .orderBy("avg_arr_delay", "airline"))


def live_predicted_rate(predictions: DataFrame) -> DataFrame:
    """Per airline: share of flights predicted delayed and the mean probability."""
    return (predictions.groupBy("airline")
            .agg(F.avg("pred_delayed").alias("predicted_delayed_rate"),
                 F.avg("p_delayed").alias("mean_delay_probability"),
                 F.count(F.lit(1)).alias("n"))
            .orderBy("predicted_delayed_rate", "airline"))
