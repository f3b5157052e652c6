"""Physical-plan properties that keep the queries scalable."""

import re

from tarmac.operators import ingest as IN
from tarmac.operators import replay as RP
from tarmac.plans.catalog import QUERIES
from tarmac.schema import CURATED_COLUMNS
from tarmac.session import work_dir
from tarmac.sinks import writers as W
from tarmac.sources import files as FS
from tarmac.sources.fixtures import flights

from conftest import SF_SMALL


def plan_of(df) -> str:
    spark = df.sparkSession
    previous = spark.conf.get("spark.sql.maxMetadataStringLength")
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")  # do not truncate scan details
    try:
        return df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.maxMetadataStringLength", previous)


def test_broadcast_sides_are_bounded_by_bytes(spark):
    """With the threshold below every table, the fact table's and all other joins shuffle."""
    previous = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")
    try:
        assert "BroadcastExchange" not in plan_of(QUERIES["agg1_delay_by_airline"](spark, SF_SMALL))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", previous)


def test_scans_read_only_needed_columns(spark):
    plan = plan_of(QUERIES["agg1_delay_by_airline"](spark, SF_SMALL))
    li = re.search(r"FileScan parquet \[([^\]]*)\][^\n]*lineitem", plan).group(1)
    assert "l_discount" not in li and "l_tax" not in li and "l_returnflag" not in li
    assert "IsNotNull(l_orderkey)" in plan


def test_recent_months_prunes_partitions_at_runtime(spark):
    path = work_dir(spark, "plan_curated")
    W.write_curated(IN.curated_projection(flights(spark, SF_SMALL), CURATED_COLUMNS), path)
    rows = RP.replay_rows(FS.read_curated(spark, path), 3)
    plan = plan_of(rows)
    pf = re.findall(r"PartitionFilters: \[([^\]]*)\]", plan)
    assert any("year" in f and "month" in f and "Subquery" in f for f in pf)


def test_global_numbering_has_no_single_partition_window_over_rows(spark):
    plan = plan_of(RP.replay_plan(flights(spark, SF_SMALL), months=None, rows_per_batch=100))
    # the only window is over the per-partition counts (fed by an aggregate of _pid)
    windows = [l for l in plan.split("\n") if "Window [" in l]
    assert windows and all("_cnt" in w for w in windows)


def test_aggregates_are_partial_before_the_shuffle(spark):
    plan = plan_of(QUERIES["agg3_most_delayed_routes"](spark, SF_SMALL))
    assert "partial_avg" in plan and "partial_count" in plan
