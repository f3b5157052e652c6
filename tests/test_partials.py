"""Month states, refreshed only for the months written; the newest month from metadata."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tarmac.operators import ingest as IN
from tarmac.operators import partials as PA
from tarmac.operators import replay as RP
from tarmac.operators import summaries as SU
from tarmac.schema import CURATED_COLUMNS
from tarmac.session import input_state, work_dir
from tarmac.sinks import writers as W
from tarmac.sources import files as FS
from tarmac.sources.fixtures import flights


@pytest.fixture(scope="module")
def rows(spark):
    path = work_dir(spark, "t_partials_source")
    IN.curated_projection(flights(spark, SF_SMALL), CURATED_COLUMNS).write.parquet(path)
    return spark.read.parquet(path)


def table(df):
    return [tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in df.collect()]


def month_files(spark, path, year, month):
    return input_state(spark, f"{path}/year={year}/month={month}")


def test_two_loads_equal_the_full_recompute(spark, rows):
    curated, states = work_dir(spark, "t_cur"), work_dir(spark, "t_states")
    march = PA.in_months([(1998, 3)])
    months = PA.load_months(rows.where(~march), curated, states)
    assert (1998, 3) not in months and len(months) > 12
    before = month_files(spark, states, 1998, 4)
    assert PA.load_months(rows.where(march), curated, states) == [(1998, 3)]
    assert month_files(spark, states, 1998, 4) == before  # untouched months keep their files
    found = spark.read.parquet(states)
    for dims, settings in ((["airline"], {}), (["year", "month"], {}), (["month"], {}), (["origin", "dest"], {"min_n": 10, "top_k": 7}), (["day_of_week"], {})):
        measures = ("arr_delay", "dep_delay")
        assert table(PA.summary_from_states(found, dims, measures, **settings)) == table(SU.delay_summary(rows, dims, measures, **settings))
    one = PA.merged(found, []).first()
    expected = rows.agg(F.stddev_samp("arr_delay"), F.min("arr_delay"), F.max("arr_delay"), F.corr("distance", "arr_delay")).first()
    assert (one.sd_arr_delay, one.min_arr_delay, one.max_arr_delay) == (pytest.approx(expected[0]), expected[1], expected[2])
    assert PA.correlation_from_states(found).first()[0] == pytest.approx(expected[3], abs=1e-9)


def test_a_refresh_scans_only_its_months(spark, rows):
    curated = work_dir(spark, "t_cur_plan")
    W.write_curated(rows, curated)
    wanted = FS.read_curated(spark, curated).where(PA.in_months([(1998, 3), (1997, 12)]))
    plan = wanted._jdf.queryExecution().executedPlan().toString()
    filters = plan[plan.index("PartitionFilters: [") :].split("]")[0]
    assert "1998" in filters and "1997" in filters
    files = {r[0] for r in wanted.select(F.input_file_name()).distinct().collect()}
    assert len(files) == 2 < len(FS.read_curated(spark, curated).inputFiles())
    assert PA.months_of(PA.partial_states(wanted)) == [(1997, 12), (1998, 3)]


def test_states_of_vanished_months_and_empty_loads(spark, rows):
    curated, states = work_dir(spark, "t_cur_gone"), work_dir(spark, "t_states_gone")
    two = rows.where(PA.in_months([(1998, 3), (1998, 4)]))
    PA.load_months(two, curated, states)
    assert PA.load_months(two.limit(0), curated, states) == []
    W.write_curated(two.where("month = 4"), curated)  # March is gone
    PA.refresh_states(spark, curated, states, [(1998, 3), (1998, 4)])
    assert PA.months_of(spark.read.parquet(states)) == [(1998, 4)]
    nulls = spark.createDataFrame([("AA", "X", "Y", None, None, None, "Mon", 2000, 1)], "airline string, origin string, dest string, arr_delay double, "
                                  "dep_delay double, distance double, day_of_week string, year int, month int")
    PA.load_months(nulls, work_dir(spark, "t_n"), states)
    assert table(PA.summary_from_states(spark.read.parquet(states).where("year = 2000"), "airline")) == [("AA", None, 1)]


def test_newest_month_reads_no_data(spark, rows):
    path = work_dir(spark, "t_newest")
    W.write_curated(rows, path)
    own = spark.newSession()
    own.conf.set("spark.sql.sources.useV1SourceList", "avro,csv,json,kafka,orc,text")
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    plan = FS.newest_date_query(own, path)._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [MAX(flight_date)]" in plan
    assert FS.newest_date(spark, path) == rows.agg(F.max("flight_date")).first()[0]
    recent = FS.read_recent_months(spark, path, 3)
    expected = RP.recent_months(rows, 3)
    assert recent.select("flight_date", "airline", "arr_delay").exceptAll(expected.select("flight_date", "airline", "arr_delay")).count() == 0
    assert recent.count() == expected.count()
    files = recent.select(F.input_file_name()).distinct().count()
    assert files == 3 < len(FS.read_curated(spark, path).inputFiles())


def test_newest_month_of_dateless_and_texty_tables(spark):
    path = work_dir(spark, "t_nodates")
    schema = "flight_date date, airline string, year int, month int"
    spark.createDataFrame([(None, "AA", 2000, 1), (dt.date(2000, 12, 5), "BB", 2000, 12), (dt.date(2001, 1, 1), "CC", 2001, 1)], schema).write.partitionBy(
        "year", "month").parquet(path)
    assert FS.newest_date(spark, path) == dt.date(2001, 1, 1)
    assert sorted(r.airline for r in FS.read_recent_months(spark, path, 2).collect()) == ["BB", "CC"]
    none = work_dir(spark, "t_alldateless")
    spark.createDataFrame([(None, "AA", 2000, 1)], schema).write.partitionBy("year", "month").parquet(none)
    assert FS.newest_date(spark, none) is None and FS.read_recent_months(spark, none, 2).count() == 0
