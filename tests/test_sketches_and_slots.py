"""Month sketches against exact ranks; bounded indexes of wide categoricals."""

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tarmac.functions.columns import route_label
from tarmac.operators import ingest as IN
from tarmac.operators import partials as PA
from tarmac.operators import sketches as SK
from tarmac.operators import wide as WI
from tarmac.plans.ml import feature_names
from tarmac.schema import CURATED_COLUMNS
from tarmac.session import input_state, work_dir
from tarmac.sinks import writers as W
from tarmac.sources.fixtures import flights


@pytest.fixture(scope="module")
def rows(spark):
    path = work_dir(spark, "t_sketch_source")
    IN.curated_projection(flights(spark, SF_SMALL), CURATED_COLUMNS).where("year = 1997").write.parquet(path)
    return spark.read.parquet(path)


def errors(rows, found, measures=SK.MEASURES):
    ranked = SK.rank_shares(rows, found, measures)
    return ranked.select("measure", "p", SK.rank_error(F.col("p"), F.col("below"), F.col("upto")).alias("e")).collect()


def test_merged_months_keep_the_rank_bound(spark, rows):
    sketches = SK.month_sketches(rows)
    assert sketches.groupBy("measure").agg(F.sum("n")).where(f"`sum(n)` = {rows.count()}").count() == 3
    found = SK.quantiles(sketches, (0.0, 0.01, 0.1, 0.5, 0.9, 0.99, 1.0))
    got = errors(rows, found)
    assert len(got) == 21 and max(r.e for r in got) <= SK.RANK_ERROR
    ends = {(r.measure, r.p): r.value for r in found.where("p IN (0, 1)").collect()}
    for m in SK.MEASURES:
        assert (ends[m, 0.0], ends[m, 1.0]) == tuple(rows.agg(F.min(m), F.max(m)).first())


def test_a_small_sketch_of_many_rows_stays_within_its_own_bound(spark):
    """A sketch that must throw values away, over many months, on a continuous column."""
    many = spark.range(0, 400_000, 1, 16).select((F.col("id") % 5 + 2000).cast("int").alias("year"), (F.col("id") % 12 + 1).cast("int").alias("month"),
                                                 (F.pow(F.rand(7), F.lit(3.0)) * 1e6).alias("distance"))
    kept = work_dir(spark, "t_many")
    many.write.parquet(kept)
    many = spark.read.parquet(kept)
    found = SK.quantiles(SK.month_sketches(many, ["distance"], k=400), (0.05, 0.25, 0.5, 0.75, 0.95), k=400)
    assert max(r.e for r in errors(many, found, ["distance"])) <= 0.03
    size = SK.merged_sketches(SK.month_sketches(many, ["distance"])).select(F.length("sketch")).first()[0]
    assert size < 200_000  # of 3.2 MB of values


def test_any_range_and_groups(spark, rows):
    sketches = SK.month_sketches(rows, ["arr_delay"], ["airline"])
    some = sketches.where("month BETWEEN 3 AND 5")
    found = SK.quantiles(some, (0.0, 0.5, 1.0), ["airline"])
    exact = {r.airline: (r.lo, r.hi, r.n) for r in rows.where("month BETWEEN 3 AND 5").groupBy("airline").agg(
        F.min("arr_delay").alias("lo"), F.max("arr_delay").alias("hi"), F.count("arr_delay").alias("n")).collect()}
    by = {(r.airline, r.p): r for r in found.collect()}
    assert {a for a, _ in by} == set(exact)
    for a, (lo, hi, n) in exact.items():
        assert (by[a, 0.0].value, by[a, 1.0].value, by[a, 0.0].n) == (lo, hi, n)
    over_all = SK.quantiles(some, (0.5,)).first()
    assert over_all.n == sum(n for *_, n in exact.values())


def test_a_refresh_replaces_only_its_months(spark, rows):
    curated, path = work_dir(spark, "t_sk_cur"), work_dir(spark, "t_sk")
    W.write_curated(rows.where("month <> 3 OR dayofmonth(flight_date) < 9"), curated)
    SK.refresh_sketches(spark, curated, path)
    before = input_state(spark, f"{path}/year=1997/month=4")
    W.write_curated(rows.where("month = 3"), curated, only_written=True)
    SK.refresh_sketches(spark, curated, path, [(1997, 3)])
    assert input_state(spark, f"{path}/year=1997/month=4") == before
    found = SK.quantiles(spark.read.parquet(path))
    assert {r.n for r in found.collect()} == {rows.count()} and max(r.e for r in errors(rows, found)) <= SK.RANK_ERROR
    W.write_curated(rows.where("month <> 3"), curated)
    SK.refresh_sketches(spark, curated, path, [(1997, 3)])
    assert (1997, 3) not in PA.months_of(spark.read.parquet(path))


def test_sketches_of_nothing(spark):
    empty = spark.createDataFrame([(2000, 1, None), (2000, 1, float("nan"))], "year int, month int, arr_delay double")
    assert SK.month_sketches(empty, ["arr_delay"]).count() == 0
    assert SK.quantiles(SK.month_sketches(empty, ["arr_delay"])).count() == 0


def routes(spark):
    return flights(spark, SF_SMALL).select(route_label().alias("route"), "dep_delay")


def test_frequent_labels_have_slots_of_their_own(spark):
    df = routes(spark)
    index = WI.fit_index(df, "route", 20, 8)
    counts = sorted(((-r.n, r.route) for r in df.groupBy("route").agg(F.count(F.lit(1)).alias("n")).collect()))
    assert index.labels == tuple(route for _, route in counts[:20]) and index.size == 29 == len(index.names())
    slotted = WI.with_slot(df, "route", index)
    assert slotted.columns == ["route", "dep_delay", "route_slot"] and slotted.count() == df.count()
    per_label = slotted.groupBy("route").agg(F.min("route_slot").alias("a"), F.max("route_slot").alias("b")).collect()
    assert all(r.a == r.b for r in per_label)
    assert {r.route: r.a for r in per_label if r.a < 20} == {route: k for k, route in enumerate(index.labels)}
    assert all(20 <= r.a < 28 for r in per_label if r.route not in index.labels)
    plan = slotted._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan


def test_width_is_fixed_and_names_resolve(spark):
    df = routes(spark)
    for sample in (df, df.limit(3)):
        index = WI.fit_index(sample, "route", 20, 8)
        slotted = WI.with_slot(sample, "route", index)
        stages = [OneHotEncoder(inputCol="route_slot", outputCol="route_oh", dropLast=False), VectorAssembler(inputCols=["route_oh", "dep_delay"], outputCol="features")]
        made = Pipeline(stages=stages).fit(slotted).transform(slotted)
        assert made.select("features").first()[0].size == index.size + 1
        assert feature_names(made) == [f"route_oh_{n}" for n in index.names()] + ["dep_delay"]


def test_ties_nulls_empty_and_unseen_labels(spark):
    df = spark.createDataFrame([("b",), ("a",), ("",), (None,), (None,), (None,), ("c",)], "x string")
    index = WI.fit_index(df, "x", 2, 4)
    assert index.labels == ("", "a")
    slots = {r.x: r.x_slot for r in WI.with_slot(df, "x", index).collect()}
    assert (slots[""], slots["a"], slots[None]) == (0.0, 1.0, 6.0) and 2 <= slots["b"] <= 5
    none = WI.fit_index(df.limit(0), "x", 2, 4)
    assert none.labels == () and none.size == 7 and len(none.names()) == 7
    assert {r.x_slot for r in WI.with_slot(df.where("x IS NOT NULL"), "x", none).collect()} <= {2.0, 3.0, 4.0, 5.0}
    assert WI.fit_index(df, "x", 0, 1).size == 2
    with pytest.raises(ValueError):
        WI.fit_index(df, "x", WI.MOST_SLOTS + 1)
