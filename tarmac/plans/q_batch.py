"""Batch analytics queries over the test tables and their DuckDB oracles.

Each entry of ``QUERIES`` takes ``(spark, sf_dir)`` and returns a DataFrame; the
matching entry of ``ORACLES`` (when the operator is expressible in SQL) computes
the same table in DuckDB from the same parquet files.  Column names agree.
Averages of integer-valued measures and ratios of counts are exact in both
engines and left unrounded; other floats are rounded to 6 decimals on both
sides.  Keys carry the inventory ID of the operator they exercise.

Every query reads the whole test tables (no id subsets, no row caps); a limit
appears only where it is the operator (top-k, bounded sample).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.functions.columns import (
    delayed_label,
    hhmm_to_hour,
    parse_date_multi,
    route_label,
    to_double,
    year_month_label,
)
from tarmac.operators import evaluate as EV
from tarmac.operators import ingest as IN
from tarmac.operators import replay as RP
from tarmac.operators import sampling as SM
from tarmac.operators import summaries as SU
from tarmac.plans import oracle as O
from tarmac.plans.ml import monthly_table
from tarmac.plans import sql as S
from tarmac.plans.registry import register
from tarmac.schema import CURATED_COLUMNS
from tarmac.sources.fixtures import flights, flights_cleaned, raw_flights_text

# Thresholds used by the registered queries.  The reference's absolute cut-offs
# (routes with >= 500 flights, airports with >= 1000) leave no route at sf0.01,
# whose routes have 12-291 flights; routes use 100 there.
ROUTE_MIN_FLIGHTS = 100
AIRPORT_MIN_FLIGHTS = 1000
TOP_ROUTES = 20
TOP_AIRPORTS = 15
TOP_MONTHS = 5
SAMPLE_ROWS = 1000
REPLAY_MONTHS = 3
REPLAY_ROWS_PER_BATCH = 200
# Columns whose text identifies a flight for hashing (split / sample keys).
FLIGHT_KEY = ("flight_date", "airline", "origin", "dest", "crs_dep_time", "dep_delay", "arr_delay")
FLIGHT_KEY_SQL = "concat_ws('|', " + ", ".join(
    f"coalesce(CAST({c} AS VARCHAR), '')" for c in FLIGHT_KEY) + ")"


def with_label(df: DataFrame) -> DataFrame:
    return df.withColumn("delayed", delayed_label("arr_delay", 15.0))


# ====================================================================== SQL
@register(
    "sql1_by_airline",
    O.oracle("""
        SELECT airline, COUNT(*) AS num_flights, AVG(arr_delay) AS avg_arr_delay,
               AVG(dep_delay) AS avg_dep_delay
        FROM flights GROUP BY airline"""),
)
def q_sql1(spark, sf):
    return S.run_sql(flights(spark, sf), S.by_airline())


@register(
    "sql2_by_month",
    O.oracle("""
        SELECT year, month, COUNT(*) AS num_flights, AVG(arr_delay) AS avg_arr_delay
        FROM flights GROUP BY year, month"""),
)
def q_sql2(spark, sf):
    return S.run_sql(flights(spark, sf), S.by_month())


@register(
    "sql3_by_route",
    O.oracle(f"""
        SELECT origin, dest, COUNT(*) AS num_flights, AVG(arr_delay) AS avg_arr_delay
        FROM flights GROUP BY origin, dest HAVING COUNT(*) >= {ROUTE_MIN_FLIGHTS}
        ORDER BY avg_arr_delay DESC, origin, dest LIMIT {TOP_ROUTES}"""),
)
def q_sql3(spark, sf):
    return S.run_sql(flights(spark, sf), S.by_route(ROUTE_MIN_FLIGHTS, TOP_ROUTES))


@register(
    "sql4_airport_on_time",
    O.oracle(
        f"""
        SELECT origin AS airport, len(delays) AS num_flights,
               {O.half_up_rate('len(list_filter(delays, lambda d: d <= 15))', 'len(delays)')} AS on_time_rate
        FROM (SELECT origin, list(arr_delay) AS delays FROM flights GROUP BY origin)
        WHERE len(delays) >= {AIRPORT_MIN_FLIGHTS}""",
    ),
)
def q_sql4(spark, sf):
    return S.run_sql(flights(spark, sf), S.airport_on_time(AIRPORT_MIN_FLIGHTS))


# =============================================================== summaries
@register(
    "agg1_delay_by_airline",
    O.oracle("SELECT airline, AVG(arr_delay) AS avg_arr_delay, COUNT(*) AS n FROM flights GROUP BY airline"),
)
def q_agg1(spark, sf):
    return SU.delay_summary(flights(spark, sf), "airline")


@register(
    "agg2_delay_by_year_month",
    O.oracle("""SELECT year, month, AVG(arr_delay) AS avg_arr_delay, COUNT(*) AS n
                FROM flights GROUP BY year, month"""),
)
def q_agg2(spark, sf):
    return SU.delay_summary(flights(spark, sf), ["year", "month"], order_by="year", descending=False)


@register(
    "agg3_most_delayed_routes",
    O.oracle(f"""SELECT origin, dest, AVG(arr_delay) AS avg_arr_delay, COUNT(*) AS n
                 FROM flights GROUP BY origin, dest HAVING COUNT(*) >= {ROUTE_MIN_FLIGHTS}"""),
)
def q_agg3(spark, sf):
    return SU.delay_summary(flights(spark, sf), ["origin", "dest"], min_n=ROUTE_MIN_FLIGHTS)


@register(
    "agg4_cancellations_by_code",
    O.oracle('SELECT cancellation_code, COUNT(*) AS "count" FROM cleaned GROUP BY cancellation_code'),
)
def q_agg4(spark, sf):
    # counted on the cleaned stage: cancelled flights have no arrival delay and
    # would vanish from the arrived stage
    return SU.count_by(flights_cleaned(spark, sf), "cancellation_code")


def _top_airports_sql(dim: str) -> str:
    return O.oracle(f"""
        SELECT {dim}, AVG(arr_delay) AS avg_arr_delay, COUNT(*) AS n
        FROM flights GROUP BY {dim} HAVING COUNT(*) >= {AIRPORT_MIN_FLIGHTS}
        ORDER BY avg_arr_delay DESC, {dim} LIMIT {TOP_AIRPORTS}""")


@register("agg5_top_origin_airports", _top_airports_sql("origin"))
def q_agg5(spark, sf):
    return SU.delay_summary(flights(spark, sf), "origin", min_n=AIRPORT_MIN_FLIGHTS, top_k=TOP_AIRPORTS)


@register("agg6_top_dest_airports", _top_airports_sql("dest"))
def q_agg6(spark, sf):
    return SU.delay_summary(flights(spark, sf), "dest", min_n=AIRPORT_MIN_FLIGHTS, top_k=TOP_AIRPORTS)


@register(
    "agg7_distribution_summary",
    O.oracle("""
        SELECT 'count' AS summary, CAST(COUNT(arr_delay) AS DOUBLE) AS arr_delay FROM flights
        UNION ALL SELECT 'mean', round(AVG(arr_delay), 6) FROM flights
        UNION ALL SELECT 'stddev', round(stddev_samp(arr_delay), 6) FROM flights
        UNION ALL SELECT 'min', MIN(arr_delay) FROM flights
        UNION ALL SELECT '25%', percentile_disc(0.25) WITHIN GROUP (ORDER BY arr_delay) FROM flights
        UNION ALL SELECT '50%', percentile_disc(0.5) WITHIN GROUP (ORDER BY arr_delay) FROM flights
        UNION ALL SELECT '75%', percentile_disc(0.75) WITHIN GROUP (ORDER BY arr_delay) FROM flights
        UNION ALL SELECT 'max', MAX(arr_delay) FROM flights"""),
)
def q_agg7(spark, sf):
    return SU.distribution_summary(flights(spark, sf), "arr_delay")


@register(
    "agg8_delay_correlation",
    O.oracle("""SELECT round(corr(distance, arr_delay), 6) AS distance_arr_delay_corr,
                       round(corr(dep_delay, arr_delay), 6) AS dep_delay_arr_delay_corr
                FROM flights"""),
)
def q_agg8(spark, sf):
    return SU.correlation(flights(spark, sf), [("distance", "arr_delay"), ("dep_delay", "arr_delay")])


@register(
    "agg9_dep_vs_arr_by_airline",
    O.oracle("""SELECT airline, AVG(dep_delay) AS avg_dep_delay, AVG(arr_delay) AS avg_arr_delay,
                       COUNT(*) AS n FROM flights GROUP BY airline"""),
)
def q_agg9(spark, sf):
    return SU.delay_summary(flights(spark, sf), "airline", ["dep_delay", "arr_delay"],
                            order_by="avg_arr_delay")


@register(
    "agg10_delay_by_weekday",
    O.oracle("""SELECT day_of_week, AVG(arr_delay) AS avg_arr_delay, COUNT(*) AS n,
                       CAST(list_position(['Mon','Tue','Wed','Thu','Fri','Sat','Sun'], day_of_week)
                            AS INTEGER) AS day_order
                FROM flights GROUP BY day_of_week"""),
)
def q_agg10(spark, sf):
    return SU.weekday_summary(flights(spark, sf))


@register(
    "agg11_delay_by_month_only",
    O.oracle("SELECT month, AVG(arr_delay) AS avg_arr_delay, COUNT(*) AS n FROM flights GROUP BY month"),
)
def q_agg11(spark, sf):
    return SU.delay_summary(flights(spark, sf), "month", order_by="month", descending=False)


@register(
    "agg13_row_count",
    O.oracle("""SELECT COUNT(*) AS n_rows, CAST(count_if(arr_delay > 15) AS BIGINT) AS positive,
                       CAST(count_if(arr_delay <= 15) AS BIGINT) AS negative FROM flights"""),
)
def q_agg13(spark, sf):
    return SU.row_counts(with_label(flights(spark, sf)), "delayed")


@register(
    "fea1_delayed_label",
    O.oracle("""SELECT CAST(arr_delay > 15 AS INTEGER) AS delayed, COUNT(*) AS n,
                       MIN(arr_delay) AS min_arr_delay, MAX(arr_delay) AS max_arr_delay
                FROM flights GROUP BY 1"""),
)
def q_fea1(spark, sf):
    """The classification label (arrival delay strictly above 15 minutes) and its ranges."""
    return (with_label(flights(spark, sf)).groupBy("delayed")
            .agg(F.count(F.lit(1)).alias("n"), F.min("arr_delay").alias("min_arr_delay"),
                 F.max("arr_delay").alias("max_arr_delay")))


@register(
    "agg14_histogram",
    O.oracle(
        """
        SELECT bin, round(lo + bin * w, 6) AS bin_lo, round(lo + (bin + 1) * w, 6) AS bin_hi,
               COUNT(*) AS n
        FROM (SELECT CAST(CASE WHEN w = 0 THEN 0 ELSE least(floor((v - lo) / w), 49) END AS INTEGER)
                         AS bin, lo, w
              FROM vals CROSS JOIN bounds)
        GROUP BY bin, lo, w""",
        """
        vals AS (SELECT least(greatest(arr_delay, -60.0), 300.0) AS v FROM flights
                 WHERE arr_delay IS NOT NULL),
        bounds AS (SELECT min(v) AS lo, (max(v) - min(v)) / 50 AS w FROM vals)""",
    ),
)
def q_agg14(spark, sf):
    return SU.histogram(flights(spark, sf), "arr_delay", -60.0, 300.0, 50)


@register(
    "agg17_cancellation_share_pct",
    O.oracle("""
        SELECT cancellation_code, COUNT(*) AS "count",
               round(CAST(COUNT(*) AS DOUBLE) * 100.0 / CAST(SUM(COUNT(*)) OVER () AS DOUBLE), 6)
                   AS share_pct
        FROM cleaned GROUP BY cancellation_code"""),
)
def q_agg17(spark, sf):
    return SU.share_pct(flights_cleaned(spark, sf), "cancellation_code")


@register(
    "agg_multi_dimension_grouping_sets",
    O.oracle("""
        SELECT 'airline' AS grouping_set, airline, NULL::VARCHAR AS origin, NULL::INTEGER AS month,
               AVG(arr_delay) AS avg_arr_delay, COUNT(*) AS n FROM flights GROUP BY airline
        UNION ALL
        SELECT 'origin', NULL, origin, NULL, AVG(arr_delay), COUNT(*) FROM flights GROUP BY origin
        UNION ALL
        SELECT 'month', NULL, NULL, month, AVG(arr_delay), COUNT(*) FROM flights GROUP BY month"""),
)
def q_grouping_sets(spark, sf):
    return SU.multi_dimension_summary(flights(spark, sf), [["airline"], ["origin"], ["month"]])


# ============================================================ sort / top-k
MONTHLY_AIRLINE_SQL = """
    monthly AS (
        SELECT month, airline, COUNT(*) AS total_flights,
               CAST(count_if(arr_delay > 15) AS BIGINT) AS total_delays, AVG(arr_delay) AS avg_arr_delay
        FROM flights GROUP BY month, airline
    )"""


@register(
    "met10_top_months_by_delays",
    O.oracle(f"""SELECT * FROM monthly
                 ORDER BY total_delays DESC, month, airline LIMIT {TOP_MONTHS}""", MONTHLY_AIRLINE_SQL),
)
def q_top_months(spark, sf):
    return (monthly_table(flights(spark, sf))
            .orderBy(F.col("total_delays").desc(), "month", "airline").limit(TOP_MONTHS))


@register(
    "flt2_drop_null_any",
    O.oracle("""SELECT month, airline, cancellation_code, COUNT(*) AS n FROM cleaned
                WHERE arr_delay IS NULL AND cancellation_code IS NOT NULL GROUP BY ALL
                HAVING COUNT(*) > 0"""),
)
def q_flt2(spark, sf):
    """Groups of cleaned rows (delayed and cancelled ones) with every NULL group dropped."""
    groups = flights_cleaned(spark, sf).groupBy("month", "airline", "cancellation_code").agg(
        F.count(F.lit(1)).alias("n"))
    return IN.drop_null_any(groups)


@register(
    "smp1_bounded_sample",
    O.oracle(f"""
        SELECT flight_date, airline, origin, dest, arr_delay, dep_delay, distance, crs_dep_time
        FROM flights
        ORDER BY md5({FLIGHT_KEY_SQL}), {', '.join(c + ' NULLS FIRST' for c in FLIGHT_KEY)}
        LIMIT {SAMPLE_ROWS}"""),
)
def q_smp1(spark, sf):
    fl = flights(spark, sf).select("flight_date", "airline", "origin", "dest", "arr_delay",
                                   "dep_delay", "distance", "crs_dep_time")
    return SM.bounded_sample(fl, SAMPLE_ROWS, FLIGHT_KEY)


@register(
    "spl1_train_test_split",
    O.oracle(f"""
        SELECT split, COUNT(*) AS n_rows, CAST(count_if(arr_delay > 15) AS BIGINT) AS n_delayed
        FROM (SELECT *, CASE WHEN ('0x' || substr(md5({FLIGHT_KEY_SQL}), 1, 8))::BIGINT % 100 < 70
                             THEN 'train' ELSE 'test' END AS split FROM flights)
        GROUP BY split"""),
)
def q_spl1(spark, sf):
    tagged = SM.with_split(flights(spark, sf), FLIGHT_KEY, 70)
    return tagged.groupBy("split").agg(F.count(F.lit(1)).alias("n_rows"),
                                       F.count_if(F.col("arr_delay") > 15).alias("n_delayed"))


# ================================================== ingest of dirty raw text
RAW_COPIES_SQL = "CASE WHEN l_orderkey % 100 = 0 THEN 2 ELSE 1 END"


@register(
    "prj10_coalesce_alias",
    O.oracle("""SELECT airline, COUNT(*) AS n, CAST(COUNT(arr_delay) AS BIGINT) AS n_delays,
                       SUM(arr_delay) AS sum_delay FROM cleaned GROUP BY airline"""),
)
def q_prj10(spark, sf):
    """Two spellings of the arrival delay, each filled in every other row, merged into one column."""
    rows = flights_cleaned(spark, sf)
    first = F.col("crs_dep_time") % 2 == 0
    feed = rows.select("airline", F.when(first, F.col("arr_delay")).alias("ArrDelay"),
                       F.when(~first, F.col("arr_delay")).alias("arrival_delay"))
    merged = IN.coalesce_spellings(feed, "arrival_delay", ["ArrDelay"])
    return merged.groupBy("airline").agg(
        F.count(F.lit(1)).alias("n"), F.count("arrival_delay").alias("n_delays"),
        F.sum("arrival_delay").alias("sum_delay"))


@register("prj1_rename_headers")
def q_prj1(spark, sf):
    return IN.rename_headers(raw_flights_text(spark, sf))


@register(
    "prj1_rename_headers_text",
    O.oracle(f"""
        SELECT CASE l_orderkey % 3 WHEN 0 THEN strftime(flight_date, '%Y-%m-%d')
                                   WHEN 1 THEN strftime(flight_date, '%-m/%-d/%Y')
                                   ELSE strftime(flight_date, '%m/%d/%Y') END AS flight_date,
               CASE WHEN l_linenumber % 2 = 1 THEN ' ' || airline || '  ' ELSE airline END AS airline,
               CASE WHEN l_orderkey % 2 = 1 THEN ' ' || origin || '  ' ELSE origin END AS origin,
               CASE WHEN l_orderkey % 2 = 0 THEN ' ' || dest || '  ' ELSE dest END AS dest,
               CAST(SUM({RAW_COPIES_SQL}) AS BIGINT) AS n
        FROM base GROUP BY 1, 2, 3, 4"""),
)
def q_prj1_text(spark, sf):
    """The raw text under its canonical names, untouched."""
    renamed = IN.rename_headers(raw_flights_text(spark, sf))
    return renamed.groupBy("flight_date", "airline", "origin", "dest").agg(F.count(F.lit(1)).alias("n"))


@register(
    "prj2_parse_date_multi",
    O.oracle(f"""SELECT CAST(year(flight_date) AS INTEGER) AS year,
                        CAST(month(flight_date) AS INTEGER) AS month,
                        CAST(SUM({RAW_COPIES_SQL}) AS BIGINT) AS n
                 FROM base GROUP BY 1, 2"""),
)
def q_prj2(spark, sf):
    d = parse_date_multi("FL_DATE")
    return (raw_flights_text(spark, sf)
            .groupBy(F.year(d).alias("year"), F.month(d).alias("month"))
            .agg(F.count(F.lit(1)).alias("n")))


@register(
    "prj3_year_month",
    O.oracle("SELECT year, month, COUNT(*) AS n FROM cleaned GROUP BY year, month"),
)
def q_prj3(spark, sf):
    return (IN.clean(raw_flights_text(spark, sf))
            .groupBy("year", "month").agg(F.count(F.lit(1)).alias("n")))


@register(
    "prj4_weekday_label",
    O.oracle("SELECT day_of_week, COUNT(*) AS n FROM cleaned GROUP BY day_of_week"),
)
def q_prj4(spark, sf):
    return (IN.clean(raw_flights_text(spark, sf))
            .groupBy("day_of_week").agg(F.count(F.lit(1)).alias("n")))


@register(
    "prj5_numeric_cast",
    O.oracle(f"""
        SELECT CAST(SUM({RAW_COPIES_SQL}) AS BIGINT) AS n_rows,
               CAST(SUM(CASE WHEN l_partkey % 50 <> 0 THEN {RAW_COPIES_SQL} ELSE 0 END) AS BIGINT) AS n_arr_delay,
               SUM(CASE WHEN l_partkey % 50 <> 0
                        THEN (l_quantity + l_partkey % 7 - 14) * {RAW_COPIES_SQL} END) AS sum_arr_delay,
               SUM((l_quantity - 10) * {RAW_COPIES_SQL}) AS sum_dep_delay,
               MIN(l_extendedprice / 100) AS min_distance, MAX(l_extendedprice / 100) AS max_distance
        FROM base"""),
)
def q_prj5(spark, sf):
    raw = raw_flights_text(spark, sf)
    arr, dep, dist = to_double("ARR_DELAY"), to_double("DEP_DELAY"), to_double("DISTANCE")
    return raw.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count(arr).alias("n_arr_delay"),
        F.sum(arr).alias("sum_arr_delay"),
        F.sum(dep).alias("sum_dep_delay"),
        F.min(dist).alias("min_distance"),
        F.max(dist).alias("max_distance"),
    )


@register(
    "prj6_trim_strings",
    O.oracle("""
        SELECT 'airline' AS code, airline AS value, COUNT(*) AS n FROM cleaned GROUP BY airline
        UNION ALL SELECT 'origin', origin, COUNT(*) FROM cleaned GROUP BY origin
        UNION ALL SELECT 'dest', dest, COUNT(*) FROM cleaned GROUP BY dest
        UNION ALL SELECT 'cancellation_code', cancellation_code, COUNT(*) FROM cleaned
                  WHERE cancellation_code IS NOT NULL GROUP BY cancellation_code"""),
)
def q_prj6(spark, sf):
    c = IN.clean(raw_flights_text(spark, sf))
    long = c.select(F.stack(
        F.lit(4),
        F.lit("airline"), "airline", F.lit("origin"), "origin", F.lit("dest"), "dest",
        F.lit("cancellation_code"), "cancellation_code",
    ).alias("code", "value"))
    return (long.where(F.col("value").isNotNull())
            .groupBy("code", "value").agg(F.count(F.lit(1)).alias("n")))


@register(
    "prj7_hhmm_to_hour",
    O.oracle(f"""SELECT CAST(l_orderkey % 24 AS INTEGER) AS dep_hour, CAST(SUM({RAW_COPIES_SQL}) AS BIGINT) AS n
                 FROM base GROUP BY 1"""),
)
def q_prj7(spark, sf):
    return (raw_flights_text(spark, sf)
            .groupBy(hhmm_to_hour("CRS_DEP_TIME").alias("dep_hour"))
            .agg(F.count(F.lit(1)).alias("n")))


@register(
    "prj9_fill_missing_derived",
    O.oracle("SELECT year, month, day_of_week, COUNT(*) AS n FROM flights GROUP BY 1, 2, 3"),
)
def q_prj9(spark, sf):
    # a feed that lacks the derived columns: they arrive NULL and are re-derived
    fl = flights(spark, sf).withColumns({
        "year": F.lit(None).cast("int"), "month": F.lit(None).cast("int"),
        "day_of_week": F.lit(None).cast("string"),
    })
    return (IN.fill_missing_derived(fl)
            .groupBy("year", "month", "day_of_week").agg(F.count(F.lit(1)).alias("n")))


@register(
    "prj11_route_label",
    O.oracle(f"""SELECT concat_ws('→', origin, dest) AS route, AVG(arr_delay) AS avg_arr_delay,
                        COUNT(*) AS n
                 FROM flights GROUP BY origin, dest HAVING COUNT(*) >= {ROUTE_MIN_FLIGHTS}"""),
)
def q_prj11(spark, sf):
    s = SU.delay_summary(flights(spark, sf), ["origin", "dest"], min_n=ROUTE_MIN_FLIGHTS)
    return s.select(route_label("origin", "dest").alias("route"), "avg_arr_delay", "n")


@register(
    "prj12_year_month_label",
    O.oracle("""SELECT printf('%d-%02d', year, month) AS year_month, AVG(arr_delay) AS avg_arr_delay,
                       COUNT(*) AS n FROM flights GROUP BY year, month"""),
)
def q_prj12(spark, sf):
    s = SU.delay_summary(flights(spark, sf), ["year", "month"], order_by="year", descending=False)
    return s.select(year_month_label("year", "month").alias("year_month"), "avg_arr_delay", "n")


@register(
    "dst1_dedup_rows",
    O.oracle(f"""SELECT (SELECT CAST(SUM({RAW_COPIES_SQL}) AS BIGINT) FROM base) AS n_raw,
                        (SELECT COUNT(*) FROM (SELECT DISTINCT * FROM cleaned)) AS n_distinct"""),
)
def q_dst1(spark, sf):
    """Rows delivered and rows left after de-duplication, from one pass: the
    full-row grouping that de-duplicates also counts each row's copies."""
    raw = IN.normalise(raw_flights_text(spark, sf))
    groups = raw.groupBy(*raw.columns).agg(F.count(F.lit(1)).alias("_copies"))
    return groups.agg(F.sum("_copies").alias("n_raw"), F.count(F.lit(1)).alias("n_distinct"))


@register("ingest_cleaned", O.oracle("SELECT * FROM cleaned"))
def q_ingest_cleaned(spark, sf):
    return IN.curated_projection(IN.clean(raw_flights_text(spark, sf)), CURATED_COLUMNS)


@register("flt1_drop_null_required", O.oracle("SELECT * FROM flights"))
def q_flt1(spark, sf):
    return IN.curated_projection(IN.arrived(IN.clean(raw_flights_text(spark, sf))), CURATED_COLUMNS)


# ======================================================= replay numbering
REPLAY_COLS = ("flight_date", "airline", "origin", "dest", "arr_delay", "dep_delay", "distance",
               "month", "year", "day_of_week")
REPLAY_ORDER_SQL = ", ".join(f"{c} ASC NULLS FIRST" for c in REPLAY_COLS)
RECENT_SQL = f"""
    recent AS (
        SELECT {', '.join(REPLAY_COLS)} FROM flights
        WHERE year * 12 + (month - 1) >= (SELECT max(year * 12 + (month - 1)) FROM flights)
                                          - {REPLAY_MONTHS - 1}
    )"""


@register(
    "flt5_recent_months",
    O.oracle("SELECT year, month, COUNT(*) AS n FROM recent GROUP BY year, month", RECENT_SQL),
)
def q_flt5(spark, sf):
    return (RP.recent_months(flights(spark, sf), REPLAY_MONTHS)
            .groupBy("year", "month").agg(F.count(F.lit(1)).alias("n")))


@register(
    "win1_global_batch_number",
    O.oracle(f"""
        SELECT *, CAST((rn - 1) // {RP.DEFAULT_ROWS_PER_BATCH} AS INTEGER) AS batch_id
        FROM (SELECT {', '.join(REPLAY_COLS)}, row_number() OVER (ORDER BY {REPLAY_ORDER_SQL}) AS rn
              FROM flights)"""),
)
def q_win1(spark, sf):
    rows = RP.replay_rows(flights(spark, sf), months=None)
    return RP.batch_numbers(rows, RP.DEFAULT_ROWS_PER_BATCH, keep_rn=True)


@register(
    "str4_replay_plan",
    O.oracle(
        f"""
        SELECT CAST((rn - 1) // {REPLAY_ROWS_PER_BATCH} AS INTEGER) AS batch_id, COUNT(*) AS n_rows,
               MIN(flight_date) AS first_date, MAX(flight_date) AS last_date,
               SUM(arr_delay) AS sum_arr_delay
        FROM (SELECT *, row_number() OVER (ORDER BY {REPLAY_ORDER_SQL}) AS rn FROM recent)
        GROUP BY 1""",
        RECENT_SQL,
    ),
)
def q_str4(spark, sf):
    plan = RP.replay_plan(flights(spark, sf), REPLAY_MONTHS, REPLAY_ROWS_PER_BATCH)
    return RP.batch_profile(plan)


# ===================================== evaluation tables, departure-delay rule
# A transparent baseline scorer derived from the data itself: the departure
# delay as the score for "arrives more than 15 minutes late", and as the
# prediction of the arrival delay.  Model-based variants live in plans.ml.
@register(
    "met2_rmse_r2",
    O.oracle("""
        SELECT COUNT(*) AS n, round(sqrt(SUM((arr_delay - dep_delay) * (arr_delay - dep_delay)) / COUNT(*)), 6)
                   AS rmse,
               round(1 - SUM((arr_delay - dep_delay) * (arr_delay - dep_delay))
                         / (var_pop(arr_delay) * COUNT(*)), 6) AS r2
        FROM flights"""),
)
def q_met2(spark, sf):
    return EV.regression_metrics(flights(spark, sf), "arr_delay", "dep_delay")


@register(
    "met3_exact_auc",
    O.oracle(
        """
        SELECT CAST(SUM(pos) AS BIGINT) AS n_pos, CAST(SUM(neg) AS BIGINT) AS n_neg,
               SUM(pos * (coalesce(neg_below, 0) + neg * 0.5)) / (SUM(pos) * SUM(neg)) AS auc
        FROM (SELECT *, SUM(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
                        AS neg_below FROM scores)""",
        """
        scores AS (SELECT CAST(dep_delay AS DOUBLE) AS score, CAST(count_if(arr_delay > 15) AS BIGINT) AS pos,
                          CAST(count_if(arr_delay <= 15) AS BIGINT) AS neg FROM flights GROUP BY 1)""",
    ),
)
def q_met3(spark, sf):
    return EV.exact_auc(with_label(flights(spark, sf)), "delayed", "dep_delay")


@register(
    "met4_confusion_matrix",
    O.oracle("""SELECT CAST(arr_delay > 15 AS INTEGER) AS y, CAST(dep_delay > 15 AS INTEGER) AS yhat,
                       COUNT(*) AS "count" FROM flights GROUP BY 1, 2"""),
)
def q_met4(spark, sf):
    fl = with_label(flights(spark, sf)).withColumn("prediction", (F.col("dep_delay") > 15).cast("int"))
    return EV.confusion_matrix(fl, "delayed", "prediction")


@register(
    "met5_class_balance",
    O.oracle("SELECT CAST(count_if(arr_delay > 15) AS BIGINT) AS positive, CAST(count_if(arr_delay <= 15) AS BIGINT) AS negative FROM flights"),
)
def q_met5(spark, sf):
    return EV.class_balance(with_label(flights(spark, sf)), "delayed")


@register(
    "met8_roc_curve",
    O.oracle(
        """
        SELECT NULL::DOUBLE AS threshold, 0.0::DOUBLE AS fpr, 0.0::DOUBLE AS tpr
        UNION ALL
        SELECT score, SUM(neg) OVER w / SUM(neg) OVER (), SUM(pos) OVER w / SUM(pos) OVER ()
        FROM scores
        WINDOW w AS (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
        """
        scores AS (SELECT CAST(dep_delay AS DOUBLE) AS score, CAST(count_if(arr_delay > 15) AS BIGINT) AS pos,
                          CAST(count_if(arr_delay <= 15) AS BIGINT) AS neg FROM flights GROUP BY 1)""",
    ),
)
def q_met8(spark, sf):
    return EV.roc_curve(with_label(flights(spark, sf)), "delayed", "dep_delay")

