"""Replay numbering partitions the recent rows exactly into fixed-size batches."""

from pyspark.sql import functions as F

from tarmac.operators import replay as RP
from tarmac.sources.fixtures import flights

from conftest import SF_MID


def test_replay_batches_partition_the_input(spark):
    fl = flights(spark, SF_MID)
    recent = RP.replay_rows(fl, months=3)
    plan = RP.replay_plan(fl, months=3, rows_per_batch=97, keep_rn=True)
    n = recent.count()
    assert plan.count() == n
    # every row exactly once
    assert plan.drop("rn", "batch_id").exceptAll(recent).count() == 0
    sizes = sorted((r["batch_id"], r["count"]) for r in plan.groupBy("batch_id").count().collect())
    assert [b for b, _ in sizes] == list(range(len(sizes)))
    assert all(c == 97 for _, c in sizes[:-1]) and 0 < sizes[-1][1] <= 97
    # batches follow date order
    spans = plan.groupBy("batch_id").agg(F.min("flight_date").alias("lo"), F.max("flight_date").alias("hi"))
    spans = sorted((r["batch_id"], r["lo"], r["hi"]) for r in spans.collect())
    assert all(a[2] <= b[1] for a, b in zip(spans, spans[1:]))


def test_recent_months_bounds(spark):
    fl = flights(spark, SF_MID)
    months = sorted({(r.year, r.month) for r in RP.recent_months(fl, 3).select("year", "month").distinct().collect()})
    assert months == [(2001, 9), (2001, 10), (2001, 11)]
