"""Steps that several jobs need run once: joins, parsing, tagging, scoring input, staged loads."""

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql.readwriter import DataFrameWriter

from conftest import SF_SMALL
from tarmac.functions.columns import DATE_PATTERNS, parse_date_multi
from tarmac.operators import appends as AP
from tarmac.plans import ml as ML
from tarmac.plans import q_io, q_ml
from tarmac.session import Fixtures, work_dir
from tarmac.sources.fixtures import flights, stored_flights
from tarmac.streaming import jobs as J


def test_a_date_layout_is_tried_only_on_text_with_its_separators(spark):
    texts = ["2000-01-05", "1/5/2000", "01/05/2000", "13/40/2000", "2000-1-5", "2000/01/05", "-", "/", "", " ", "x-y/z", "1-2/3", None]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    plain = F.coalesce(*[F.try_to_date("t", p) for p in DATE_PATTERNS])
    found = rows.select("t", parse_date_multi("t").alias("d"), plain.alias("same"))
    assert [r for r in found.collect() if r["d"] != r["same"]] == []
    assert found.where("d IS NOT NULL").count() >= 3
    assert "Contains(t" in found._jdf.queryExecution().executedPlan().toString()
    # optional parts need no separator
    loose = rows.select(parse_date_multi("t", ["yyyy[-MM][-dd]"]).alias("d"), F.try_to_date("t", "yyyy[-MM][-dd]").alias("same"))
    assert all(r["d"] == r["same"] for r in loose.collect())


def test_stored_flights_are_the_flights_without_their_joins(spark):
    stored, made = stored_flights(spark, SF_SMALL), flights(spark, SF_SMALL)
    assert stored.columns == made.columns and stored.dtypes == made.dtypes
    assert stored.exceptAll(made).count() == 0 and made.exceptAll(stored).count() == 0
    assert "Join" not in stored._jdf.queryExecution().executedPlan().toString()


def test_the_models_of_a_session_share_one_tagged_table(spark):
    tagged = q_ml.tagged_flights(spark, SF_SMALL)
    assert tagged is q_ml.tagged_flights(spark, SF_SMALL) and tagged.storageLevel.useMemory
    for spec in (q_ml.LR, q_ml.LINREG):
        plan = q_ml.fitted(spark, SF_SMALL, spec).tagged._jdf.queryExecution().executedPlan().toString()
        assert "InMemoryTableScan" in plan


def test_rows_tagged_for_classification_serve_regression(spark):
    day = dt.date(2000, 1, 3)
    made = [(day, "AA" if i % 2 else "BB", f"o{i % 3}", f"d{i % 5}", "Mon", float(i % 11) if i % 7 else None, float(i), 1, 2000,
             float("nan") if i % 13 == 0 else None if i % 17 == 0 else float(i % 29)) for i in range(400)]
    rows = spark.createDataFrame(made, "flight_date date, airline string, origin string, dest string, day_of_week string, "
                                       "dep_delay double, distance double, month int, year int, arr_delay double")
    spec, key = ML.ModelSpec("regress", "linreg"), ["flight_date", "airline", "origin", "dest", "distance"]
    alone = ML.fit_and_score(rows, spec, key)
    shared = ML.fit_tagged(ML.tagged_rows(rows, ML.ModelSpec("classify", "lr"), key), spec)
    assert ML.run_counts(shared).collect() == ML.run_counts(alone).collect()
    assert [round(c, 6) for c in shared.estimator.coefficients] == [round(c, 6) for c in alone.estimator.coefficients]


def test_a_scored_batch_is_parsed_once(spark, monkeypatch):
    src, out = work_dir(spark, "t_once_src"), work_dir(spark, "t_once_out")
    spark.createDataFrame([("AA", 1.0), ("BB", None)], "airline string, arr_delay double").write.parquet(src)
    kept = []

    def score(model, batch, outputs, keep):
        kept.append(batch.storageLevel.useMemory)
        return batch

    monkeypatch.setattr(J, "score_rows", score)
    stream = J.read_table_stream(spark, src, "part-*", spark.read.parquet(src).schema, max_files_per_trigger=100)
    J.run_scoring(stream, None, out, work_dir(spark, "t_once_ckpt"))
    assert kept == [True]


def test_a_first_load_is_staged_once_and_grouped_without_its_digest(spark, monkeypatch):
    written, plans = [], []
    real = DataFrameWriter.parquet

    def parquet(self, path, *args, **kw):
        written.append(path)
        plans.append(self._df._jdf.queryExecution().executedPlan().toString())
        return real(self, path, *args, **kw)

    monkeypatch.setattr(DataFrameWriter, "parquet", parquet)
    path = work_dir(spark, "t_first")
    rows = spark.createDataFrame([(dt.date(2000, 1, 2), "AA", 1.0, 2000, 1)] * 3, "flight_date date, airline string, arr_delay double, year int, month int")
    assert AP.append_new(rows, path) == AP.Appended(3, 1, ((2000, 1),))
    assert len(written) == 2 and written[1] == path
    assert all("md5" not in line for line in plans[0].split("Exchange")[1:])


def test_the_deliveries_are_parsed_once(spark, monkeypatch):
    reads, real = [], q_io.FS.read_raw_csv
    monkeypatch.setattr(q_io.FS, "read_raw_csv", lambda *a, **k: reads.append(1) or real(*a, **k))
    monkeypatch.setattr(q_io, "_LOADS", Fixtures(keep=4))
    _, done = q_io.appended_loads(spark, SF_SMALL)
    assert reads == [1] and [d[0] for d in done] == ["first", "second", "again"] and done[2][2] == 0
