"""Writers, readers and stream recovery."""

import time

import pytest
from pyspark.sql import functions as F

from tarmac.operators import ingest as IN
from tarmac.operators import replay as RP
from tarmac.schema import AGG_STREAM_SCHEMA, CURATED_COLUMNS
from tarmac.session import work_dir
from tarmac.sinks import writers as W
from tarmac.sources import files as FS
from tarmac.sources.fixtures import flights
from tarmac.streaming import jobs as J

from conftest import SF_SMALL


def _batch_avg(fl):
    return {r.airline: (r.avg_arr_delay, r.n) for r in
            fl.groupBy("airline").agg(F.avg("arr_delay").alias("avg_arr_delay"),
                                      F.count(F.lit(1)).alias("n")).collect()}


def test_stream_restart_from_checkpoint_does_not_double_count(spark):
    fl = flights(spark, SF_SMALL)
    src = work_dir(spark, "t_replay")
    W.write_replay_files(RP.replay_plan(fl, months=None, rows_per_batch=700), src)
    out, ckpt = work_dir(spark, "t_snap"), work_dir(spark, "t_ckpt")

    def agg():
        s = J.normalise_stream(J.read_replay_stream(J.state_session(spark), src, AGG_STREAM_SCHEMA, 1))
        return J.running_avg_by_airline(s.select("airline", "arr_delay"))

    # first run: processing-time trigger, stopped after it has committed some micro-batches
    q = J.run_snapshots(agg(), out, ckpt, available_now=False, processing_time="200 milliseconds")
    deadline = time.time() + 120
    while (q.lastProgress is None or q.lastProgress["batchId"] < 2) and time.time() < deadline:
        time.sleep(0.2)
    q.stop()
    first_batches = q.lastProgress["batchId"]
    assert 2 <= first_batches
    # restart on the same checkpoint: only the remaining files are read
    J.run_snapshots(agg(), out, ckpt)
    got = {r.airline: (r.avg_arr_delay, r.n) for r in J.latest_snapshot(spark, out).collect()}
    assert got == _batch_avg(fl)
    assert spark.read.parquet(out).agg(F.max("batch")).first()[0] >= first_batches


def test_curated_write_replaces_only_written_months(spark):
    fl = IN.curated_projection(flights(spark, SF_SMALL), CURATED_COLUMNS)
    path = work_dir(spark, "t_curated")
    W.write_curated(fl, path)
    total = fl.count()
    one_month = fl.where((F.col("year") == 1998) & (F.col("month") == 3))
    W.write_curated(one_month.limit(5), path, only_written=True)  # overwrite March 1998 only
    back = FS.read_curated(spark, path)
    assert back.count() == total - one_month.count() + min(5, one_month.count())
    assert back.where((F.col("year") == 1998) & (F.col("month") == 3)).count() == min(5, one_month.count())


def test_load_flights_prefers_curated_and_falls_back(spark):
    fl = IN.curated_projection(flights(spark, SF_SMALL), CURATED_COLUMNS)
    path = work_dir(spark, "t_cur2")
    W.write_curated(fl, path)
    assert FS.load_flights(spark, path).count() == fl.count()
    with pytest.raises(FS.NoInputError):
        FS.load_flights(spark, work_dir(spark, "missing"), None)
