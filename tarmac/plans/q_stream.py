"""Streaming queries: replay the flights as files, run the stream to completion
(``availableNow``, a fixed number of micro-batches), return what the sink holds.

The whole flight table is replayed (20,000 rows per file, the replay default),
so the streams' work grows with the data.  The final complete-mode snapshot of a
running aggregate equals the batch aggregate, which is its oracle.
"""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.operators import replay as RP
from tarmac.plans import oracle as O
from tarmac.plans.q_ml import LR, fitted, save_and_load
from tarmac.plans.registry import register
from tarmac.schema import AGG_STREAM_SCHEMA, SCORED_COLUMNS, STREAM_SCHEMA
from tarmac.session import Fixtures, list_folder, remove_folder, shuffles_removed, work_dir
from tarmac.sinks import writers as W
from tarmac.sources import files as FS
from tarmac.sources.fixtures import stored_flights
from tarmac.streaming import jobs as J

ROWS_PER_FILE = RP.DEFAULT_ROWS_PER_BATCH
# A drain takes this many micro-batches whatever the volume: the rate follows the data.
MICRO_BATCHES = 8

_RUNS = Fixtures(keep=8)


def files_per_trigger(spark: SparkSession, folder: str) -> int:
    return max(1, -(-len(list_folder(spark, folder)) // MICRO_BATCHES))


def write_replay(spark: SparkSession, feed: DataFrame, path: str) -> None:
    """A whole feed as compressed replay files; nothing of its numbering or its shuffles stays on disk."""
    numbered = work_dir(spark, "numbered")
    plan = RP.replay_plan(feed, months=None, rows_per_batch=ROWS_PER_FILE, folder=numbered)
    with shuffles_removed(spark):
        W.write_replay_files(plan, path, compression="lz4")
    remove_folder(spark, numbered)


def replay_folder(spark: SparkSession, sf_dir: str) -> str:
    """All arrived flights as replay CSV files (one file per 20,000 rows, a folder each)."""

    def make():
        path = work_dir(spark, "replay_all")
        write_replay(spark, stored_flights(spark, sf_dir), path)
        # the sink's marker is no input
        remove_folder(spark, f"{path}/_SUCCESS")
        return path

    return _RUNS.get(spark, sf_dir, "replay", make, remove_folder)


def snapshot_folder(spark: SparkSession, sf_dir: str) -> str:
    """Run the running-average stream over the replay files; return its sink folder."""

    def make():
        src = replay_folder(spark, sf_dir)
        out, ckpt = work_dir(spark, "avg_by_airline"), work_dir(spark, "avg_by_airline_ckpt")
        own = J.state_session(spark)
        stream = J.normalise_stream(
            J.read_replay_stream(own, src, AGG_STREAM_SCHEMA, files_per_trigger(spark, src)))
        J.run_snapshots(J.running_avg_by_airline(stream.select("airline", "arr_delay")), out, ckpt, keep=3)
        remove_folder(spark, ckpt)
        return out

    return _RUNS.get(spark, sf_dir, "snapshots", make, remove_folder)


def predictions_folder(spark: SparkSession, sf_dir: str) -> str:
    """Score the replay stream with the saved-and-reloaded pipeline; return its sink folder."""

    def make():
        model = save_and_load(spark, fitted(spark, sf_dir, LR))
        src = replay_folder(spark, sf_dir)
        out, ckpt = work_dir(spark, "predictions"), work_dir(spark, "predictions_ckpt")
        stream = J.normalise_stream(J.read_replay_stream(spark, src, STREAM_SCHEMA, files_per_trigger(spark, src)))
        J.run_scoring(stream, model, out, ckpt, keep=SCORED_COLUMNS)
        remove_folder(spark, ckpt)
        return out

    return _RUNS.get(spark, sf_dir, "predictions", make, remove_folder)


AVG_BY_AIRLINE_SQL = "SELECT airline, AVG(arr_delay) AS avg_arr_delay, COUNT(*) AS n FROM flights GROUP BY airline"


@register("str1_stream_avg_by_airline", O.oracle(AVG_BY_AIRLINE_SQL))
def q_str1(spark, sf):
    return J.latest_snapshot(spark, snapshot_folder(spark, sf)).drop("batch")


@register(
    "str7_latest_snapshot",
    O.oracle(f"""
        SELECT airline, AVG(arr_delay) AS avg_arr_delay, COUNT(*) AS n,
               (SELECT CAST(ceil(f / ceil(f / {MICRO_BATCHES})) - 1 AS INTEGER)
                FROM (SELECT ceil(COUNT(*) / {ROWS_PER_FILE}) AS f FROM flights)) AS batch
        FROM flights GROUP BY airline"""),
)
def q_str7(spark, sf):
    """Newest snapshot with its micro-batch number (the drain takes at most MICRO_BATCHES)."""
    return J.latest_snapshot(spark, snapshot_folder(spark, sf))


@register(
    "str3_stream_normalise",
    O.oracle("""SELECT flight_date, airline, origin, dest, arr_delay, dep_delay, distance,
                       month, year, day_of_week FROM flights"""),
)
def q_str3(spark, sf):
    """A feed without the derived columns and with padded codes, cleaned as a stream."""
    src = work_dir(spark, "feed")
    feed = RP.replay_plan(stored_flights(spark, sf), months=None, rows_per_batch=ROWS_PER_FILE).withColumns({
        "airline": F.concat(F.lit(" "), "airline", F.lit(" ")),
        "month": F.lit(None).cast("int"), "year": F.lit(None).cast("int"),
        "day_of_week": F.lit(None).cast("string"),
    })
    W.write_replay_files(feed, src)
    out, ckpt = work_dir(spark, "normalised"), work_dir(spark, "normalised_ckpt")
    stream = J.normalise_stream(J.read_replay_stream(spark, src, STREAM_SCHEMA, files_per_trigger(spark, src)))
    J.run_append(stream, out, ckpt)
    remove_folder(spark, src)
    remove_folder(spark, ckpt)
    return spark.read.parquet(out).select(*[f.name for f in STREAM_SCHEMA.fields])


@register(
    "str1_stream_avg_events",
    "SELECT event_type AS airline, round(AVG(value), 6) AS avg_arr_delay, COUNT(*) AS n "
    "FROM events WHERE event_type IS NOT NULL AND value IS NOT NULL GROUP BY event_type",
)
def q_str1_events(spark, sf):
    """The running average over the events table read as a Parquet file stream
    (event type in the airline role, value in the delay role)."""
    # spread over several files, so that state crosses micro-batches
    folder = work_dir(spark, "events_feed")
    events = spark.read.parquet(f"{sf.rstrip('/')}/events.parquet")
    events.repartition(2 * MICRO_BATCHES).write.parquet(folder)
    own = J.state_session(spark)
    stream = J.read_table_stream(own, folder, "part-*", events.schema, max_files_per_trigger=2)
    mapped = J.normalise_stream(stream.select(F.col("event_type").alias("airline"),
                                              F.col("value").alias("arr_delay")))
    out, ckpt = work_dir(spark, "events_avg"), work_dir(spark, "events_avg_ckpt")
    J.run_snapshots(J.running_avg_by_airline(mapped), out, ckpt, keep=3)
    remove_folder(spark, folder)
    remove_folder(spark, ckpt)
    snap = J.latest_snapshot(spark, out)
    return snap.select("airline", F.round("avg_arr_delay", 6).alias("avg_arr_delay"), "n")


@register(
    "str2_stream_score_rows",
    O.oracle("""SELECT flight_date, airline, origin, dest, dep_delay, distance, arr_delay,
                       COUNT(*) AS n, CAST(0 AS BIGINT) AS n_unscored FROM flights GROUP BY ALL"""),
)
def q_str2_rows(spark, sf):
    """Every replayed flight is scored: its columns, how often it came, how often without a score."""
    rows = FS.read_predictions(spark, predictions_folder(spark, sf))
    return rows.groupBy(*SCORED_COLUMNS).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("pred_delayed").isNull()).alias("n_unscored"))


@register(
    "str2_stream_score_dirty_feed",
    O.oracle("""SELECT airline, COUNT(*) AS n_rows, CAST(count_if(l_orderkey % 3 <> 0) AS BIGINT) AS n_scored
                FROM base WHERE l_partkey % 50 <> 0 GROUP BY airline"""),
)
def q_str2_dirty(spark, sf):
    """A feed in which every third order's departure delay is missing is scored to its end."""
    model = save_and_load(spark, fitted(spark, sf, LR))
    src = work_dir(spark, "dirty_feed")
    hour = F.floor(F.col("crs_dep_time") / 100)  # l_orderkey % 24
    feed = stored_flights(spark, sf).withColumn("dep_delay", F.when(hour % 3 != 0, F.col("dep_delay")))
    write_replay(spark, feed, src)
    out, ckpt = work_dir(spark, "dirty_scores"), work_dir(spark, "dirty_ckpt")
    stream = J.normalise_stream(J.read_replay_stream(spark, src, STREAM_SCHEMA, files_per_trigger(spark, src)))
    J.run_scoring(stream, model, out, ckpt, keep=SCORED_COLUMNS)
    remove_folder(spark, src)
    remove_folder(spark, ckpt)
    return FS.read_predictions(spark, out).groupBy("airline").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count("pred_delayed").alias("n_scored"))


@register("str2_stream_score")
def q_str2(spark, sf):
    """All replayed flights scored by the reloaded pipeline, one batch folder per file."""
    return FS.read_predictions(spark, predictions_folder(spark, sf)).drop("pred_prob_vec")


@register("agg15_live_delay_by_airline", O.oracle(AVG_BY_AIRLINE_SQL))
def q_agg15(spark, sf):
    return J.live_delay_by_airline(FS.read_predictions(spark, predictions_folder(spark, sf)))


@register(
    "agg16_live_counts",
    O.oracle("SELECT airline, COUNT(*) AS n, TRUE AS rates_in_range FROM flights GROUP BY airline"),
)
def q_agg16_counts(spark, sf):
    """Scored flights per airline, and whether their rates are probabilities."""
    rates = J.live_predicted_rate(FS.read_predictions(spark, predictions_folder(spark, sf)))
    inside = [F.col(c).between(0, 1) for c in ("predicted_delayed_rate", "mean_delay_probability")]
    return rates.select("airline", "n", (inside[0] & inside[1]).alias("rates_in_range"))


@register("agg16_live_predicted_rate")
def q_agg16(spark, sf):
    return J.live_predicted_rate(FS.read_predictions(spark, predictions_folder(spark, sf)))


def live_state_folder(spark: SparkSession, sf_dir: str) -> str:
    """The prediction folder followed by the live-table stream; returns its state folder."""

    def make():
        out, ckpt = work_dir(spark, "live_state"), work_dir(spark, "live_state_ckpt")
        J.run_live_tables(spark, predictions_folder(spark, sf_dir), out, ckpt)
        remove_folder(spark, ckpt)
        return out

    return _RUNS.get(spark, sf_dir, "live", make, remove_folder)


@register("agg15_live_incremental", O.oracle(AVG_BY_AIRLINE_SQL))
def q_agg15_live(spark, sf):
    """The live delay table from per-batch sums that a second stream keeps: no prediction is read again."""
    return J.live_delay_from_state(spark, live_state_folder(spark, sf))


@register(
    "agg16_live_rate_step",
    O.oracle("""SELECT airline, AVG(CASE WHEN dep_delay > 15 THEN 1.0 ELSE 0.0 END) AS predicted_delayed_rate,
                       AVG(CASE WHEN dep_delay > 15 THEN 1.0 ELSE 0.0 END) AS mean_delay_probability, COUNT(*) AS n
                FROM flights GROUP BY airline"""),
)
def q_agg16_step(spark, sf):
    """Rates of a streamed model whose every prediction is known: a tree on a step of the departure delay."""

    def make():
        data = stored_flights(spark, sf).select("dep_delay", (F.col("dep_delay") > 15).cast("double").alias("y"))
        tree = RandomForestClassifier(labelCol="y", numTrees=1, maxDepth=2, maxBins=64, seed=1, bootstrap=False,
                                      featureSubsetStrategy="all")
        model = Pipeline(stages=[VectorAssembler(inputCols=["dep_delay"], outputCol="features"), tree]).fit(data)
        src = replay_folder(spark, sf)
        scored, state = work_dir(spark, "step_scores"), work_dir(spark, "step_state")
        checkpoints = [work_dir(spark, "step_ckpt") for _ in range(2)]
        stream = J.normalise_stream(J.read_replay_stream(spark, src, STREAM_SCHEMA, files_per_trigger(spark, src)))
        J.run_scoring(stream, model, scored, checkpoints[0], keep=SCORED_COLUMNS)
        J.run_live_tables(spark, scored, state, checkpoints[1])
        for folder in (scored, *checkpoints):
            remove_folder(spark, folder)
        return state

    return J.live_rate_from_state(spark, _RUNS.get(spark, sf, "step", make, remove_folder))
