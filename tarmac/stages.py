"""Runnable stages, for ``spark-submit`` or ``python -m tarmac.stages STAGE ...``.

    ingest     raw CSV folder -> curated table
    summarise  curated table -> result tables (one CSV folder each)
    train      curated table -> saved model, metrics log
    replay     curated table -> replay files
    score      replay files + model -> predictions (drains what is there, or runs on)

Every stage is a thin call of the library; all take the session that spark-submit gives.
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from tarmac.operators import ingest as IN
from tarmac.operators import replay as RP
from tarmac.operators import summaries as SU
from tarmac.plans import ml as ML
from tarmac.plans import sql as S
from tarmac.schema import CURATED_COLUMNS, SCORED_COLUMNS, STREAM_SCHEMA, has_columns, require_columns
from tarmac.session import build_session
from tarmac.sinks import writers as W
from tarmac.sources import files as FS
from tarmac.streaming import jobs as J

KEY = ("flight_date", "airline", "origin", "dest", "crs_dep_time")


def ingest(spark: SparkSession, raw: str, curated: str, only_written: bool = False) -> None:
    flights = IN.arrived(IN.clean(FS.read_raw_csv(spark, raw)))
    require_columns(flights, ("flight_date", "airline", "origin", "dest", "arr_delay"), "ingest")
    W.write_curated(IN.curated_projection(flights, CURATED_COLUMNS), curated, only_written=only_written)


def tables(flights: DataFrame, min_flights: int, top_k: int) -> dict[str, DataFrame]:
    """The result tables that the columns at hand allow; those that need a missing one are left out."""
    require_columns(flights, ("airline", "origin", "dest", "arr_delay"), "summarise")
    out = {
        "by_airline": SU.delay_summary(flights, "airline"),
        "routes": SU.delay_summary(flights, ["origin", "dest"], min_n=min_flights),
        "distribution": SU.distribution_summary(flights, "arr_delay"),
        "histogram": SU.histogram(flights),
        "by_route_sql": S.run_sql(flights, S.by_route(min_flights, top_k)),
        "airport_on_time": S.run_sql(flights, S.airport_on_time(min_flights)),
    }
    optional = {
        "by_airline_sql": (("dep_delay",), lambda: S.run_sql(flights, S.by_airline())),
        "by_month": (("year", "month"), lambda: SU.delay_summary(flights, ["year", "month"], order_by="year", descending=False)),
        "by_weekday": (("day_of_week",), lambda: SU.weekday_summary(flights)),
        "correlation": (("distance", "dep_delay"), lambda: SU.correlation(
            flights, [("distance", "arr_delay"), ("dep_delay", "arr_delay")])),
        "cancellations": (("cancellation_code",), lambda: SU.count_by(flights, "cancellation_code")),
    }
    out.update({name: make() for name, (needs, make) in optional.items() if has_columns(flights, needs)})
    return out


def summarise(spark: SparkSession, curated: str, out: str, min_flights: int = 1000, top_k: int = 20) -> None:
    for name, table in tables(FS.read_curated(spark, curated), min_flights, top_k).items():
        W.write_result_csv(table, f"{out.rstrip('/')}/{name}")


def train(spark: SparkSession, curated: str, model: str, metrics: str, task: str = "classify", algo: str = "lr",
          raw: str | None = None) -> None:
    flights = FS.load_flights(spark, curated, raw)
    require_columns(flights, ("airline", "origin", "dest", "arr_delay", "dep_delay"), "train")
    result = ML.fit_and_score(flights, ML.ModelSpec(task, algo), [c for c in KEY if c in flights.columns])
    W.save_model(result.model, model)
    W.append_metrics(ML.run_report(result), metrics)
    result.release()


def replay(spark: SparkSession, curated: str, out: str, months: int | None = 3,
           rows_per_file: int = RP.DEFAULT_ROWS_PER_BATCH) -> None:
    W.write_replay_files(RP.replay_plan(FS.read_curated(spark, curated), months, rows_per_file), out)


def score(spark: SparkSession, files: str, model: str, out: str, checkpoint: str, follow: bool = False,
          files_per_trigger: int = 1, processing_time: str = "10 seconds") -> None:
    from pyspark.ml import PipelineModel

    stream = J.normalise_stream(J.read_replay_stream(spark, files, STREAM_SCHEMA, files_per_trigger))
    query = J.run_scoring(stream, PipelineModel.load(model), out, checkpoint, available_now=not follow,
                          processing_time=processing_time, keep=SCORED_COLUMNS)
    if follow:
        query.awaitTermination()


STAGES = {"ingest": ingest, "summarise": summarise, "train": train, "replay": replay, "score": score}


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="tarmac.stages", description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    sub = top.add_subparsers(dest="stage", required=True)
    args = {name: sub.add_parser(name) for name in STAGES}
    for name, places in (("ingest", "raw curated"), ("summarise", "curated out"), ("train", "curated model metrics"),
                         ("replay", "curated out"), ("score", "files model out checkpoint")):
        for place in places.split():
            args[name].add_argument(place)
    args["ingest"].add_argument("--only-written", action="store_true", help="replace only the months that receive rows")
    args["summarise"].add_argument("--min-flights", type=int, default=1000)
    args["summarise"].add_argument("--top-k", type=int, default=20)
    args["train"].add_argument("--task", choices=list(ML.ALGOS), default="classify")
    args["train"].add_argument("--algo", choices=[a for algos in ML.ALGOS.values() for a in algos], default="lr")
    args["train"].add_argument("--raw", help="raw CSV, used when there is no curated table")
    args["replay"].add_argument("--months", type=int, default=3)
    args["replay"].add_argument("--rows-per-file", type=int, default=RP.DEFAULT_ROWS_PER_BATCH)
    args["score"].add_argument("--follow", action="store_true", help="keep running instead of draining what is there")
    args["score"].add_argument("--files-per-trigger", type=int, default=1)
    args["score"].add_argument("--processing-time", default="10 seconds")
    return top


def main(argv: Sequence[str] | None = None) -> None:
    given = vars(parser().parse_args(argv))
    STAGES[given.pop("stage")](build_session(app_name="tarmac"), **given)


if __name__ == "__main__":
    main()
