"""Benchmark: the delay-analytics pipeline end to end on one scale factor.

Setup (untimed): the test tables are turned into the dirty raw flight CSV the
pipeline ingests.  Timed steps, each an action on Spark:

  ingest_curate        raw CSV -> clean -> curated Parquet (year/month folders)
  agg*/sql*/...        summaries and SQL analyses over the curated table
  replay_files         last 3 months -> global batch numbers -> one CSV per batch
  stream_avg_by_airline  running average over the replayed files (availableNow)
  model_lr / model_linreg  fit + score + exact metrics

Prints one JSON line: {"metric", "value" (total seconds), "unit", "queries", "sf"}.
Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    m = re.search(r"sf([0-9.]+)$", sf_dir)
    sf = float(m.group(1)) if m else None

    from tarmac.operators import evaluate as EV
    from tarmac.operators import ingest as IN
    from tarmac.operators import replay as RP
    from tarmac.operators import summaries as SU
    from tarmac.plans import ml as ML
    from tarmac.plans import sql as S
    from tarmac.plans.q_batch import FLIGHT_KEY
    from tarmac.plans.q_io import write_raw_csv
    from tarmac.schema import AGG_STREAM_SCHEMA, CURATED_COLUMNS
    from tarmac.session import build_session, work_dir
    from tarmac.sinks import writers as W
    from tarmac.sources import files as FS
    from tarmac.sources.fixtures import raw_flights_text
    from tarmac.streaming import jobs as J

    spark = build_session(f"local[{cpus}]", app_name="tarmac-bench", shuffle_partitions=max(8, 2 * cpus),
                          extra_conf={"spark.driver.memory": "16g"})

    raw_dir = work_dir(spark, "bench_raw")
    write_raw_csv(raw_flights_text(spark, sf_dir), raw_dir)

    timings: dict[str, float] = {}

    def timed(name, fn):
        t0 = time.perf_counter()
        out = fn()
        timings[name] = round(time.perf_counter() - t0, 3)
        return out

    curated_dir = work_dir(spark, "bench_curated")

    def curate():
        clean = IN.arrived(IN.clean(FS.read_raw_csv(spark, raw_dir)))
        W.write_curated(IN.curated_projection(clean, CURATED_COLUMNS), curated_dir)

    timed("ingest_curate", curate)
    fl = FS.read_curated(spark, curated_dir)

    summaries = {
        "agg1_by_airline": lambda: SU.delay_summary(fl, "airline"),
        "agg2_by_year_month": lambda: SU.delay_summary(fl, ["year", "month"], order_by="year", descending=False),
        "agg3_routes": lambda: SU.delay_summary(fl, ["origin", "dest"], min_n=501),
        "agg5_top_origins": lambda: SU.delay_summary(fl, "origin", min_n=1001, top_k=15),
        "agg6_top_dests": lambda: SU.delay_summary(fl, "dest", min_n=1001, top_k=15),
        "agg7_distribution": lambda: SU.distribution_summary(fl, "arr_delay"),
        "agg8_correlation": lambda: SU.correlation(fl, [("distance", "arr_delay"), ("dep_delay", "arr_delay")]),
        "agg9_dep_vs_arr": lambda: SU.delay_summary(fl, "airline", ["dep_delay", "arr_delay"],
                                                    order_by="avg_arr_delay"),
        "agg10_weekday": lambda: SU.weekday_summary(fl),
        "agg14_histogram": lambda: SU.histogram(fl),
        "sql1_by_airline": lambda: S.run_sql(fl, S.by_airline()),
        "sql2_by_month": lambda: S.run_sql(fl, S.by_month()),
        "sql3_by_route": lambda: S.run_sql(fl, S.by_route(500, 20)),
        "sql4_airport_on_time": lambda: S.run_sql(fl, S.airport_on_time(1000)),
        # the six per-dimension tables above in one scan (GROUPING SETS)
        "agg_all_dimensions_one_pass": lambda: SU.multi_dimension_summary(
            fl, [["airline"], ["year", "month"], ["origin", "dest"], ["origin"], ["dest"], ["day_of_week"]]),
        "met3_exact_auc_dep_delay_rule": lambda: EV.exact_auc(
            fl.withColumn("delayed", (fl.arr_delay > 15).cast("int")), "delayed", "dep_delay"),
    }
    for name, build in summaries.items():
        timed(name, lambda b=build: b().collect())

    replay_dir = work_dir(spark, "bench_replay")
    timed("replay_files", lambda: W.write_replay_files(RP.replay_plan(fl, months=3), replay_dir))

    stream_src = work_dir(spark, "bench_stream_src")
    W.write_replay_files(RP.replay_plan(fl, months=None), stream_src)  # setup: the full replay

    def stream():
        out, ckpt = work_dir(spark, "bench_snap"), work_dir(spark, "bench_snap_ckpt")
        s = J.normalise_stream(J.read_replay_stream(J.state_session(spark), stream_src, AGG_STREAM_SCHEMA, 4))
        J.run_snapshots(J.running_avg_by_airline(s.select("airline", "arr_delay")), out, ckpt)
        return J.latest_snapshot(spark, out).collect()

    timed("stream_avg_by_airline", stream)

    def model(spec):
        def run():
            r = ML.fit_and_score(fl, spec, FLIGHT_KEY)
            rep = ML.run_report(r).collect()
            r.release()
            return rep

        return run

    timed("model_lr", model(ML.ModelSpec("classify", "lr")))
    timed("model_linreg", model(ML.ModelSpec("regress", "linreg")))
    timed("model_rf", model(ML.ModelSpec("classify", "rf")))
    timed("model_rfreg", model(ML.ModelSpec("regress", "rfreg")))

    total = round(sum(timings.values()), 3)
    print(json.dumps({"metric": "pipeline_total_sec", "value": total, "unit": "sec",
                      "queries": timings, "sf": sf, "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()
