"""Loads that add only new rows to a curated table."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tarmac.operators import appends as AP
from tarmac.operators import ingest as IN
from tarmac.operators import partials as PA
from tarmac.operators import summaries as SU
from tarmac.schema import CURATED_COLUMNS
from tarmac.session import input_state, work_dir
from tarmac.sinks import writers as W
from tarmac.sources.fixtures import flights

SCHEMA = "flight_date date, airline string, arr_delay double, year int, month int"


@pytest.fixture(scope="module")
def rows(spark):
    path = work_dir(spark, "t_appends_source")
    IN.curated_projection(flights(spark, SF_SMALL), CURATED_COLUMNS).where("year = 1997").write.parquet(path)
    return spark.read.parquet(path)


def content(spark, path):
    return sorted(map(str, spark.read.parquet(path).drop(AP.DIGEST).collect()))


def test_loading_twice_changes_nothing(spark, rows):
    path = work_dir(spark, "t_twice")
    first = AP.append_new(rows, path)
    assert (first.delivered, first.added, first.known) == (rows.count(), rows.count(), 0)
    assert set(first.months) == set(PA.months_of(rows))
    before, files = content(spark, path), input_state(spark, path)
    again = AP.append_new(rows.unionByName(rows), path)
    assert (again.delivered, again.added, again.months) == (2 * rows.count(), 0, ())
    assert content(spark, path) == before and input_state(spark, path) == files


@pytest.mark.parametrize("bits", [AP.BITMAP_BITS, 16 * AP.BITMAP_BITS, AP.FILTER_BYTES * 8 + AP.BITMAP_BITS])
def test_overlapping_loads_equal_the_distinct_rows(spark, rows, bits):
    """With a nearly full filter, with a large one, and beyond its bound."""
    path = work_dir(spark, "t_overlap")
    day = F.dayofmonth("flight_date")
    AP.append_new(rows.where(day <= 20), path, bits)
    done = AP.append_new(rows.where(day > 10), path, bits)
    assert done.added == rows.where(day > 20).count()
    back = spark.read.parquet(path).select(*rows.columns)
    assert back.exceptAll(rows).count() == 0 and rows.exceptAll(back).count() == 0


def test_the_filter_passes_most_new_rows_by(spark, rows):
    digests = AP.with_digest(rows)
    held, new = digests.where("dep_delay < 10"), digests.where("dep_delay >= 10")
    tagged = AP.split_by_filter(digests, AP.membership(held))
    assert tagged.columns == [*digests.columns, "_maybe"]
    assert tagged.where("dep_delay < 10 AND NOT _maybe").count() == 0  # never misses what is held
    assert tagged.where("dep_delay >= 10 AND _maybe").count() <= new.count() // 50
    plan = tagged._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_only_touched_months_and_the_digest_are_read(spark, rows):
    path = work_dir(spark, "t_pruned")
    AP.append_new(rows, path)
    held = AP.held_digests(spark, path, [(1997, 3), (1997, 12)])
    assert len({r[0] for r in held.select(F.input_file_name()).distinct().collect()}) == 2
    plan = held._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<row_digest:binary>" in plan


def test_nulls_zeros_repeats_and_empty_loads(spark):
    path = work_dir(spark, "t_nulls")
    day = dt.date(2000, 1, 2)
    load = spark.createDataFrame([(None, "AA", None, None, None), (None, "AA", None, None, None), (day, "", 0.0, 2000, 1),
                                  (day, None, float("nan"), 2000, 1)], SCHEMA)
    assert AP.append_new(load.limit(0), path).added == 0
    assert AP.append_new(load, path) == AP.Appended(4, 3, ((2000, 1),))
    more = spark.createDataFrame([(None, "AA", None, None, None), (day, "", -0.0, 2000, 1), (day, None, float("nan"), 2000, 1),
                                  (day, None, None, 2000, 1), (day, "", None, 2000, 1)], SCHEMA)
    assert AP.append_new(more, path) == AP.Appended(5, 2, ((2000, 1),))
    assert AP.append_new(load.limit(0), path) == AP.Appended(0, 0, ())
    assert spark.read.parquet(path).count() == 5


def test_a_table_without_digests(spark, rows):
    path = work_dir(spark, "t_plain")
    W.write_curated(rows.where("month <= 6"), path)
    done = AP.append_new(rows, path)
    assert done.added == rows.where("month > 6").count()
    back = spark.read.parquet(path)
    assert AP.DIGEST not in back.columns and back.count() == rows.count()


def test_states_follow_the_appended_months(spark, rows):
    path, states = work_dir(spark, "t_app"), work_dir(spark, "t_app_states")
    PA.load_months(AP.with_digest(rows.where("month <= 6")), path, states)
    done = AP.append_months(rows, path, states)
    assert {m for _, m in done.months} == {7, 8, 9, 10, 11, 12}
    found = PA.summary_from_states(spark.read.parquet(states), "airline").select("airline", F.round("avg_arr_delay", 6), "n").collect()
    assert found == SU.delay_summary(rows, "airline").select("airline", F.round("avg_arr_delay", 6), "n").collect()
