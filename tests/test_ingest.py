"""Ingest traps on hand-made rows: each dirty case the cleaning must handle."""

import datetime as dt

from pyspark.sql import functions as F

from tarmac.functions.columns import hhmm_to_hour, parse_date_multi, weekday_ordinal, year_month_label
from tarmac.operators import ingest as IN

RAW = ["FL_DATE", "AIRLINE", "OP_CARRIER", "ORIGIN", "DEST", "ARR_DELAY", "DEP_DELAY", "DISTANCE",
       "CANCELLATION_CODE", "CRS_DEP_TIME"]


def raw_rows(spark, rows):
    return spark.createDataFrame(rows, ", ".join(f"{c} string" for c in RAW))


def test_header_renames_first_match_wins():
    r = IN.header_renames(["FL_DATE", "AIRLINE", "OP_CARRIER", "ARR_DELAY"])
    assert r == {"FL_DATE": "flight_date", "AIRLINE": "airline", "ARR_DELAY": "arr_delay"}
    # OP_CARRIER is used only when no AIRLINE column exists
    assert IN.header_renames(["OP_CARRIER"]) == {"OP_CARRIER": "airline"}
    # already canonical: nothing to do; case-insensitive match
    assert IN.header_renames(["airline", "OP_CARRIER"]) == {}
    assert IN.header_renames(["Fl_Date"]) == {"Fl_Date": "flight_date"}


def test_date_layouts_and_garbage(spark):
    df = spark.createDataFrame([("2020-01-05",), ("1/5/2020",), ("01/05/2020",), ("12/31/2019",),
                                ("2020-13-45",), ("soon",), (None,)], "d string")
    got = [r[0] for r in df.select(parse_date_multi("d")).collect()]
    jan5 = dt.date(2020, 1, 5)
    assert got == [jan5, jan5, jan5, dt.date(2019, 12, 31), None, None, None]


def test_hhmm_hours(spark):
    df = spark.createDataFrame([("0550",), ("5",), ("2400",), ("1359",), ("553.0",), ("x",), (None,)], "t string")
    assert [r[0] for r in df.select(hhmm_to_hour("t")).collect()] == [5, 0, 24, 13, 5, None, None]


def test_labels(spark):
    df = spark.createDataFrame([("Mon", 2020, 1), ("Sun", 1999, 12)], "d string, y int, m int")
    got = df.select(weekday_ordinal("d"), year_month_label("y", "m")).collect()
    assert [tuple(r) for r in got] == [(1, "2020-01"), (7, "1999-12")]


def test_clean_dedups_after_normalising_and_keeps_cancellations(spark):
    rows = [
        # same flight in two date layouts and with padding: equal after normalising
        ("2020-01-05", " AA ", None, "JFK", " LAX", "12", "10", "2475.0", None, "0550"),
        ("1/5/2020", "AA", None, " JFK ", "LAX", "12.0", "10", "2475", None, "550"),
        # exact duplicate rows
        ("2020-01-06", "UA", None, "SFO", "ORD", "-3", "0", "1846", None, "2400"),
        ("2020-01-06", "UA", None, "SFO", "ORD", "-3", "0", "1846", None, "2400"),
        # cancelled: no arrival delay (empty / non-numeric text), code padded
        ("2020-01-07", "DL", None, "ATL", "BOS", None, None, "946", "B ", "5"),
        ("2020-01-08", "DL", None, "ATL", "BOS", "NA", "7", "946", " A", "0700"),
        # unparsable date
        ("2020-02-30x", "DL", None, "ATL", "BOS", "1", "1", "946", None, "800"),
    ]
    cleaned = IN.clean(raw_rows(spark, rows))
    assert cleaned.count() == 5
    by_code = {r[0]: r[1] for r in cleaned.groupBy("cancellation_code").count().collect()}
    assert by_code == {None: 3, "A": 1, "B": 1}
    arrived = IN.arrived(cleaned)
    assert arrived.count() == 2  # cancelled and undated rows leave
    aa = arrived.where(F.col("airline") == "AA").first()
    assert (aa.origin, aa.dest, aa.arr_delay, aa.dep_hour, aa.day_of_week) == ("JFK", "LAX", 12.0, 5, "Sun")
    ua = arrived.where(F.col("airline") == "UA").first()
    assert (ua.dep_hour, ua.year, ua.month) == (24, 2020, 1)


def test_op_carrier_fallback(spark):
    df = spark.createDataFrame([("2020-01-05", "B6", "JFK", "BOS", "3")],
                               "FL_DATE string, OP_CARRIER string, ORIGIN string, DEST string, ARR_DELAY string")
    out = IN.arrived(IN.clean(df))
    assert out.select("airline").first()[0] == "B6"


def test_fill_missing_derived(spark):
    df = spark.createDataFrame([(dt.date(2021, 3, 1), None, 7, None), (dt.date(2021, 3, 2), 1999, None, "Xyz")],
                               "flight_date date, year int, month int, day_of_week string")
    got = [tuple(r) for r in IN.fill_missing_derived(df).select("year", "month", "day_of_week").collect()]
    assert got == [(2021, 7, "Mon"), (1999, 3, "Xyz")]


def test_coalesce_spellings_case_sensitive(spark):
    spark.conf.set("spark.sql.caseSensitive", "true")
    try:
        df = spark.createDataFrame([(1.0, None, "a"), (None, 2.0, "b"), (None, None, "c")],
                                   "arr_delay double, ARR_DELAY double, k string")
        got = IN.coalesce_spellings(df, "arr_delay", ["ARR_DELAY"])
        assert sorted(got.columns) == ["arr_delay", "k"]
        assert sorted((r.k, r.arr_delay) for r in got.collect()) == [("a", 1.0), ("b", 2.0), ("c", None)]
    finally:
        spark.conf.set("spark.sql.caseSensitive", "false")
    # default resolution: one column, nothing to merge
    one = spark.createDataFrame([(3.0,)], "ARR_DELAY double")
    assert IN.coalesce_spellings(one, "arr_delay", ["ARR_DELAY"]).columns == ["arr_delay"]
