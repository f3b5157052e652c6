"""Operators on empty, one-row, one-class and huge inputs; readers and writers on bad input; stages."""

import datetime as dt
import glob

import pytest
from pyspark.sql import functions as F

from tarmac import stages
from tarmac.operators import evaluate as EV
from tarmac.operators import ingest as IN
from tarmac.operators import summaries as SU
from tarmac.operators.numbering import exact_quantiles, global_row_number, prefix_sums
from tarmac.plans import ml as ML
from tarmac.plans.catalog import QUERIES
from tarmac.plans.q_io import write_raw_csv
from tarmac.schema import AGG_STREAM_SCHEMA, CURATED_COLUMNS, SCORED_COLUMNS, STREAM_SCHEMA, MissingColumnsError
from tarmac.session import work_dir
from tarmac.sinks import writers as W
from tarmac.sources import files as FS
from tarmac.sources.fixtures import flights, raw_flights_text
from tarmac.streaming import jobs as J

from conftest import SF_SMALL

SCORES = "delayed int, score double"


# ------------------------------------------------------------- total metrics
def test_metrics_of_one_class_and_empty_input(spark):
    one = spark.createDataFrame([(1, 0.5), (1, 0.7)], SCORES)
    assert EV.exact_auc(one).first().asDict() == {"n_pos": 2, "n_neg": 0, "auc": None}
    assert [(r.threshold, r.fpr, r.tpr) for r in EV.roc_curve(one).collect()] == [(None, 0.0, 0.0), (0.7, None, 0.5), (0.5, None, 1.0)]
    none = one.limit(0)
    assert EV.exact_auc(none).first().asDict() == {"n_pos": 0, "n_neg": 0, "auc": None}
    assert [r.fpr for r in EV.roc_curve(none).collect()] == [0.0]
    summary = EV.confusion_summary(none.withColumn("prediction", F.lit(1))).first()
    assert summary["tn"] == 0 and summary["accuracy"] is None and summary["precision"] is None
    flat = spark.createDataFrame([(3.0, 2.0), (3.0, 4.0)], "arr_delay double, prediction double")
    assert EV.regression_metrics(flat).first().asDict() == {"n": 2, "rmse": 1.0, "r2": None}
    assert EV.regression_metrics(flat.limit(0)).first()["n"] == 0


def test_auc_of_billions_of_rows(spark, monkeypatch):
    counts = spark.createDataFrame([(0.0, 0, 4_000_000_000), (1.0, 4_000_000_000, 0)], "score double, pos long, neg long")
    monkeypatch.setattr(EV, "score_counts", lambda *a: counts)
    assert EV.exact_auc(counts).first()["auc"] == 1.0


def test_roc_curve_can_be_thinned(spark):
    df = spark.range(2000).select((F.col("id") % 3 == 0).cast("int").alias("delayed"), (F.col("id") / 2000).alias("score"))
    thin = EV.roc_curve(df, digits=2).collect()
    assert len(thin) < 300 < EV.roc_curve(df).count() and (thin[-1].fpr, thin[-1].tpr) == (1.0, 1.0)


@pytest.mark.parametrize("rows,expected", [
    ([], {"count": 0.0, "mean": None, "stddev": None, "min": None, "25%": None, "50%": None, "75%": None, "max": None}),
    ([5.0], {"count": 1.0, "mean": 5.0, "stddev": None, "min": 5.0, "25%": 5.0, "50%": 5.0, "75%": 5.0, "max": 5.0}),
])
@pytest.mark.parametrize("accuracy", [None, 100])
def test_distribution_of_few_rows(spark, rows, expected, accuracy):
    df = spark.createDataFrame([(r,) for r in rows], "arr_delay double")
    got = SU.distribution_summary(df, "arr_delay", approx_accuracy=accuracy).collect()
    assert {r["summary"]: r["arr_delay"] for r in got} == expected


def test_prefix_sums_of_any_key(spark):
    big = [(2**53 + i, 1) for i in range(6)]
    got = prefix_sums(spark.createDataFrame(big, "k long, w int"), "k", ["w"], partitions=3).collect()
    assert {r.k: r.cum_w for r in got} == {2**53 + i: i + 1 for i in range(6)}
    days = [(dt.date(2020, 1, d), d) for d in range(1, 9)]
    got = prefix_sums(spark.createDataFrame(days, "k date, w int"), "k", ["w"], descending=True, inclusive=False).collect()
    assert {r.k.day: r.cum_w for r in got} == {d: sum(range(d + 1, 9)) for d in range(1, 9)}
    empty = spark.createDataFrame([], "k string, w int")
    assert prefix_sums(empty, "k", ["w"]).collect() == []
    assert exact_quantiles(empty, "k", [0.5]).first()[0] is None


def test_one_shuffle_partition(spark):
    own = spark.newSession()
    own.conf.set("spark.sql.shuffle.partitions", "1")
    assert exact_quantiles(own.range(11).select(F.col("id").cast("double").alias("x")), "x", [0.5]).first()[0] == 5.0


def test_hot_ordering_value_is_cut_into_ranges(spark):
    df = spark.range(4000).select(F.lit(1).alias("day"), "id")
    numbered = global_row_number(df, ["day"], partitions=8)
    assert sorted(r.rn for r in numbered.collect()) == list(range(1, 4001))
    assert numbered.select(F.spark_partition_id().alias("p")).distinct().count() >= 6


# ------------------------------------------------------- readers and writers
def test_files_with_other_headers_fail(spark):
    path = work_dir(spark, "t_headers")
    spark.createDataFrame([("AA", "JFK")], "AIRLINE string, ORIGIN string").coalesce(1).write.option("header", True).csv(f"{path}/a")
    spark.createDataFrame([("LAX", "UA")], "ORIGIN string, AIRLINE string").coalesce(1).write.option("header", True).csv(f"{path}/b")
    with pytest.raises(Exception, match="header|schema"):
        FS.read_raw_csv(spark, path).collect()
    assert [tuple(r) for r in FS.read_raw_csv(spark, f"{path}/b").select("AIRLINE").collect()] == [("UA",)]


def test_full_overwrite_drops_months_that_left(spark):
    fl = IN.curated_projection(flights(spark, SF_SMALL), CURATED_COLUMNS).where("year = 1998 AND month <= 2")
    path = work_dir(spark, "t_full")
    W.write_curated(fl, path)
    W.write_curated(fl.where("month = 2"), path)
    assert {r.month for r in FS.read_curated(spark, path).select("month").distinct().collect()} == {2}


def test_damaged_prediction_file_fails_unless_asked(spark):
    path = work_dir(spark, "t_damaged")
    for batch in (0, 1):
        W.write_batch_snapshot(spark.range(5).coalesce(1), path, batch)
    local = path.replace("file://", "").replace("file:", "")
    victim = glob.glob(f"{local}/batch=1/**/part-*.parquet", recursive=True)[0]
    with open(victim, "wb") as f:
        f.write(b"not parquet at all")
    with pytest.raises(Exception):
        FS.read_predictions(spark, path).collect()
    assert FS.read_predictions(spark, path, ignore_corrupt=True).count() == 5


def test_joins_follow_byte_statistics_and_plan_without_jobs(spark):
    tracker = spark.sparkContext.statusTracker()
    own = spark.newSession()
    own.conf.set("spark.sql.adaptive.enabled", "false")

    def joins(threshold):
        own.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        plan = flights(own, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
        return plan.count("SortMergeJoin"), plan.count("BroadcastHashJoin")

    spark.sparkContext.setJobGroup("plan-only", "no jobs while planning")
    flights(spark, SF_SMALL)
    assert len(tracker.getJobIdsForGroup("plan-only")) <= 6  # Parquet schemas only, one per table
    spark.sparkContext.setJobGroup("tests", "")
    assert joins("-1")[0] >= 4 and joins("-1")[1] == 0
    assert joins("10485760")[1] >= 4


# ----------------------------------------------------------------- row order
@pytest.mark.parametrize("name,key", [
    ("agg1_delay_by_airline", lambda r: (-r.avg_arr_delay, r.airline)),
    ("agg2_delay_by_year_month", lambda r: (r.year, r.month)),
    ("agg5_top_origin_airports", lambda r: (-r.avg_arr_delay, r.origin)),
    ("agg10_delay_by_weekday", lambda r: r.day_order),
    ("sql1_by_airline", lambda r: (-r.avg_arr_delay, r.airline)),
    ("sql2_by_month", lambda r: (r.year, r.month)),
    ("sql4_airport_on_time", lambda r: (-r.on_time_rate, r.airport)),
    ("met10_top_months_by_delays", lambda r: (-r.total_delays, r.month, r.airline)),
    ("agg14_histogram", lambda r: r.bin),
])
def test_rows_come_in_their_order(spark, name, key):
    rows = QUERIES[name](spark, SF_SMALL).collect()
    assert rows == sorted(rows, key=key)


# ------------------------------------------------------------------- streams
def test_drain_of_many_small_files_has_no_time_limit(spark):
    src, out, ckpt = (work_dir(spark, n) for n in ("t_many", "t_many_out", "t_many_ckpt"))
    rows = spark.range(3000).select((F.col("id") % 300).alias("batch_id"), F.concat(F.lit("A"), F.col("id") % 7).alias("airline"),
                                    (F.col("id") % 50).cast("string").alias("arr_delay"))
    W.write_replay_files(rows, src, columns=("airline", "arr_delay"))
    own = J.state_session(spark)
    schema = AGG_STREAM_SCHEMA.__class__([f for f in AGG_STREAM_SCHEMA.fields if f.name in ("airline", "arr_delay")])
    stream = J.normalise_stream(J.read_replay_stream(own, src, schema, 50))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    J.run_snapshots(J.running_avg_by_airline(stream), out, ckpt, keep=2)
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    assert J.latest_snapshot(spark, out).agg(F.sum("n")).first()[0] == 3000
    assert FS.snapshot_ids(spark, out) == [4, 5]


def test_dirty_feed_is_scored_to_its_end(spark):
    fl = flights(spark, SF_SMALL)
    model = ML.fit_and_score(fl, ML.ModelSpec("classify", "lr", max_iter=3), ["flight_date", "airline", "origin", "dest"]).model
    src, out, ckpt = (work_dir(spark, n) for n in ("t_dirty", "t_dirty_out", "t_dirty_ckpt"))
    rows = fl.limit(40).select(
        "airline", "origin", "dest", F.lit("1998-01-02").alias("flight_date"), F.lit("7").alias("arr_delay"),
        F.lit("5").alias("dep_delay"), F.col("distance").cast("string").alias("distance"), F.lit("1").alias("month"),
        F.lit("1998").alias("year"), F.lit("Fri").alias("day_of_week"), F.lit(0).alias("batch_id"), F.monotonically_increasing_id().alias("i"))
    rows = rows.withColumn("dep_delay", F.when(F.col("i") % 4 != 0, F.col("dep_delay")))
    rows = rows.withColumn("flight_date", F.when(F.col("i") % 5 != 0, F.col("flight_date")).otherwise("no date"))
    rows = rows.withColumn("arr_delay", F.when(F.col("i") != 7, F.col("arr_delay")).otherwise("NA"))
    W.write_replay_files(rows, src)
    stream = J.normalise_stream(J.read_replay_stream(spark, src, STREAM_SCHEMA, 1))
    J.run_scoring(stream, model, out, ckpt, keep=SCORED_COLUMNS)
    got = FS.read_predictions(spark, out)
    assert got.where("dep_delay IS NULL AND pred_delayed IS NOT NULL").count() == 0
    assert got.where("dep_delay IS NULL").count() == 10 and got.where("pred_delayed IS NOT NULL").count() >= 20


# -------------------------------------------------------------------- stages
def test_stages_run_from_raw_csv_to_scores(spark, capsys):
    root = work_dir(spark, "t_stages")
    write_raw_csv(raw_flights_text(spark, SF_SMALL), f"{root}/raw")
    for line in (f"ingest {root}/raw {root}/curated", f"summarise {root}/curated {root}/tables --min-flights 10",
                 f"train {root}/curated {root}/model {root}/metrics", f"replay {root}/curated {root}/replay --rows-per-file 400",
                 f"score {root}/replay {root}/model {root}/scores {root}/ckpt --files-per-trigger 50"):
        stages.main(line.split())
    n = flights(spark, SF_SMALL).count()
    assert FS.read_curated(spark, f"{root}/curated").count() == n
    assert FS.read_result_csv(spark, f"{root}/tables/by_airline").agg(F.sum("n")).first()[0] == n
    assert spark.read.parquet(f"{root}/metrics").first()["roc_auc"] > 0.9
    assert FS.read_predictions(spark, f"{root}/scores").count() > 0
    with pytest.raises(MissingColumnsError):
        stages.tables(spark.range(1).withColumn("airline", F.lit("A")), 1, 1)
