"""Cross-checks between operators, and randomized checks against plain Python."""

import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from tarmac.functions.columns import hhmm_to_hour, parse_date_multi
from tarmac.operators import summaries as SU
from tarmac.operators.numbering import global_row_number
from tarmac.plans import sql as S
from tarmac.sources.fixtures import flights, flights_cleaned

from conftest import SF_SMALL


def test_dataframe_twin_equals_sql_twin(spark):
    fl = flights(spark, SF_SMALL)
    df_side = SU.delay_summary(fl, "airline", ["dep_delay", "arr_delay"])
    sql_side = S.run_sql(fl, S.by_airline())
    a = sorted((r.airline, r.n, r.avg_arr_delay, r.avg_dep_delay) for r in df_side.collect())
    b = sorted((r.airline, r.num_flights, r.avg_arr_delay, r.avg_dep_delay) for r in sql_side.collect())
    assert a == b


def test_group_counts_sum_to_the_total(spark):
    fl = flights(spark, SF_SMALL)
    total = fl.count()
    for dims in (["airline"], ["year", "month"], ["origin", "dest"], ["day_of_week"]):
        assert SU.delay_summary(fl, dims).agg(F.sum("n")).first()[0] == total
    cancelled = SU.count_by(flights_cleaned(spark, SF_SMALL), "cancellation_code")
    assert cancelled.agg(F.sum("count")).first()[0] == flights_cleaned(spark, SF_SMALL).count()
    assert SU.histogram(fl).agg(F.sum("n")).first()[0] == total


def _py_hour(text):
    try:
        return int(float(text) // 100)
    except (TypeError, ValueError):
        return None


@settings(max_examples=25, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 2400).map(str), st.integers(0, 2400).map(lambda v: f"{v:04d}"),
                          st.sampled_from(["", "x", "12a"])), min_size=1, max_size=30))
def test_hhmm_matches_python(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(hhmm_to_hour("t")).collect()]
    assert got == [_py_hour(t) for t in texts]


@settings(max_examples=25, deadline=None)
@given(st.lists(st.tuples(st.dates(dt.date(1990, 1, 1), dt.date(2030, 12, 31)), st.integers(0, 2)),
                min_size=1, max_size=30))
def test_every_date_layout_parses_back(spark, items):
    def text(d, layout):
        if layout == 0:
            return d.isoformat()
        if layout == 1:
            return f"{d.month}/{d.day}/{d.year}"
        return f"{d.month:02d}/{d.day:02d}/{d.year}"

    df = spark.createDataFrame([(text(d, k),) for d, k in items], "t string")
    assert [r[0] for r in df.select(parse_date_multi("t")).collect()] == [d for d, _ in items]


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 5)), min_size=1, max_size=200),
       st.integers(1, 9))
def test_global_row_number_random(spark, rows, parts):
    df = spark.createDataFrame(rows, "a int, b int")
    got = global_row_number(df, ["a", "b"], partitions=parts)
    want = df.withColumn("rn", F.row_number().over(Window.orderBy("a", "b")))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
