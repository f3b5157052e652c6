"""Source and sink queries: every one writes real files below the shared work
folder (``spark.checkpoint.dir``) and reads them back, so the readers and writers
are exercised on the whole data.  Oracles are the tables the round trip must
reproduce.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.operators import appends as AP
from tarmac.operators import ingest as IN
from tarmac.operators import partials as PA
from tarmac.operators import rejects as RJ
from tarmac.operators import replay as RP
from tarmac.operators import sketches as SK
from tarmac.operators import summaries as SU
from tarmac.plans import oracle as O
from tarmac.plans import sql as S
from tarmac.plans.q_batch import (
    AIRPORT_MIN_FLIGHTS,
    RECENT_SQL,
    REPLAY_MONTHS,
    REPLAY_ORDER_SQL,
    REPLAY_ROWS_PER_BATCH,
)
from tarmac.plans.registry import ORACLES, register
from tarmac.schema import CURATED_COLUMNS, STREAM_SCHEMA
from tarmac.session import Fixtures, remove_folder, work_dir
from tarmac.sinks import writers as W
from tarmac.sources import files as FS
from tarmac.sources import layouts as LA
from tarmac.sources.fixtures import flights, raw_flights_text, stored_flights


def write_raw_csv(df: DataFrame, path: str, partition_by: str | None = None) -> None:
    """Raw text as headered CSV, blanks preserved (the writer trims by default)."""
    writer = (df.write.mode("overwrite").option("header", True)
              .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False))
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.csv(path)


def raw_csv_folder(spark: SparkSession, sf_dir: str, nested: bool = False) -> str:
    """Write the dirty raw flights as CSV (flat, or spread over sub-folders)."""
    path = work_dir(spark, "raw_csv")
    raw = raw_flights_text(spark, sf_dir)
    if nested:
        # spread the files over feed=0..3 sub-folders; the reader walks them
        raw = raw.withColumn("feed", F.abs(F.hash("FL_DATE", "AIRLINE", "ORIGIN")) % 4)
        write_raw_csv(raw, path, partition_by="feed")
    else:
        write_raw_csv(raw, path)
    return path


def _cleaned_from_csv(spark: SparkSession, path: str) -> DataFrame:
    return IN.curated_projection(IN.clean(FS.read_raw_csv(spark, path)), CURATED_COLUMNS)


@register("src1_csv_scan", O.oracle("SELECT * FROM cleaned"))
def q_src1(spark, sf):
    return _cleaned_from_csv(spark, raw_csv_folder(spark, sf))


@register("src2_csv_scan_recursive", O.oracle("SELECT * FROM cleaned"))
def q_src2(spark, sf):
    return _cleaned_from_csv(spark, raw_csv_folder(spark, sf, nested=True))


@register("snk1_curated_parquet_roundtrip", O.oracle("SELECT * FROM flights"))
def q_snk1(spark, sf):
    curated = IN.curated_projection(IN.arrived(IN.clean(FS.read_raw_csv(spark, raw_csv_folder(spark, sf)))),
                                    CURATED_COLUMNS)
    path = work_dir(spark, "curated")
    W.write_curated(curated, path)
    return FS.read_curated(spark, path).select(*CURATED_COLUMNS)


@register(
    "src3_parquet_scan_pruned",
    O.oracle("SELECT airline, AVG(arr_delay) AS avg_arr_delay, COUNT(*) AS n FROM flights "
             "WHERE year = 2000 AND month >= 6 GROUP BY airline"),
)
def q_src3(spark, sf):
    """Curated table read with a partition filter: only matching folders are listed."""
    path = work_dir(spark, "curated")
    W.write_curated(IN.curated_projection(flights(spark, sf), CURATED_COLUMNS), path)
    cur = FS.read_curated(spark, path).where((F.col("year") == 2000) & (F.col("month") >= 6))
    return SU.delay_summary(cur, "airline")


@register(
    "src4_curated_or_raw",
    O.oracle("""SELECT * FROM cleaned WHERE arr_delay IS NOT NULL AND airline IS NOT NULL
                AND origin IS NOT NULL AND dest IS NOT NULL"""),
)
def q_src4(spark, sf):
    missing = work_dir(spark, "no_curated_here")
    df = FS.load_flights(spark, missing, raw_csv_folder(spark, sf))
    return IN.curated_projection(df, CURATED_COLUMNS)


@register("src4_curated_branch", O.oracle("SELECT * FROM flights"))
def q_src4_curated(spark, sf):
    """A readable curated table wins: the raw location given beside it does not exist."""
    path = work_dir(spark, "curated")
    W.write_curated(IN.curated_projection(flights(spark, sf), CURATED_COLUMNS), path)
    return FS.load_flights(spark, path, work_dir(spark, "no_raw_here")).select(*CURATED_COLUMNS)


# What three feeds call and where they put the columns; the third has no distance.
FEEDS = (
    {},
    {"CANCELLATION_CODE": "cancellation_code", "AIRLINE": "OP_CARRIER", "DEST": "dest", "ORIGIN": "origin", "FL_DATE": "flight_date",
     "DISTANCE": "Distance", "ARR_DELAY": "ARR_DELAY", "CRS_DEP_TIME": "crs_dep_time", "DEP_DELAY": "dep_delay"},
    {"FL_DATE": "FL_DATE", "OP_CARRIER": "AIRLINE", "AIRLINE": "OP_CARRIER", "ORIGIN": "ORIGIN", "DEST": "DEST", "CRS_DEP_TIME": "CRS_DEP_TIME",
     "DEP_DELAY": "DEP_DELAY", "ARR_DELAY": "ARR_DELAY", "CANCELLATION_CODE": "CANCELLATION_CODE"},
)


def _hour() -> F.Column:
    return F.floor(F.col("CRS_DEP_TIME").cast("int") / 100)  # l_orderkey % 24


def mixed_csv_folder(spark: SparkSession, sf_dir: str) -> str:
    """The raw flights as three feeds of different headers, chosen by l_orderkey % 3."""
    path = work_dir(spark, "mixed_csv")
    raw = raw_flights_text(spark, sf_dir)
    for k, columns in enumerate(FEEDS):
        rows = raw.where(_hour() % 3 == k)
        if k == 2:
            # a carrier number beside the carrier: AIRLINE wins over OP_CARRIER
            rows = rows.withColumn("OP_CARRIER", F.lit("999"))
            columns = {"FL_DATE": "FL_DATE", "OP_CARRIER": "OP_CARRIER", **{c: c for c in raw.columns if c not in ("FL_DATE", "DISTANCE")}}
        columns = columns or {c: c for c in raw.columns}
        write_raw_csv(rows.select(*[F.col(c).alias(n) for c, n in columns.items()]), f"{path}/feed{k}")
    return path


@register(
    "src1_mixed_headers",
    O.oracle("""SELECT DISTINCT * REPLACE (CASE WHEN floor(crs_dep_time / 100) % 3 <> 2 THEN distance END AS distance) FROM cleaned"""),
)
def q_src1_mixed(spark, sf):
    """One folder, three header layouts: other order, other spelling, a missing column."""
    raw = LA.read_mixed_csv(spark, mixed_csv_folder(spark, sf))
    return IN.curated_projection(IN.clean(raw), CURATED_COLUMNS)


_LOADS = Fixtures(keep=4)


def broken_csv_folder(spark: SparkSession, sf_dir: str) -> str:
    """The raw flights with broken records, chosen by the departure time."""
    raw = raw_flights_text(spark, sf_dir)
    kind = F.col("CRS_DEP_TIME").cast("int") % 11
    spoilt = {
        "FL_DATE": (0, F.lit("2001-02-30")), "AIRLINE": (1, F.lit("  ")), "DISTANCE": (2, F.lit("12 miles")),
        "ARR_DELAY": (3, F.lit("late")), "DEST": (4, F.lit(None).cast("string")),
    }
    cells = [F.when(kind == spoilt[c][0], spoilt[c][1]).otherwise(F.col(c)) if c in spoilt else F.col(c) for c in raw.columns]
    texts = [F.coalesce(c, F.lit("")) for c in cells]
    line = (F.when(kind == 5, F.concat_ws(",", *texts[:-2])).when(kind == 6, F.concat_ws(",", *texts, F.lit("one more")))
            .otherwise(F.concat_ws(",", *texts)))
    path = work_dir(spark, "broken_csv")
    (raw.select(line.alias(",".join(raw.columns))).write.option("header", True).option("sep", "\u0001").option("quote", "")
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))
    return path


KIND_SQL = """
kinds AS (
    SELECT *, ((l_orderkey % 24) * 100 + (l_linenumber * 7) % 60) % 11 AS kind,
           CASE WHEN l_orderkey % 100 = 0 THEN 2 ELSE 1 END AS copies FROM base
)"""


@register(
    "src1_reject_counts",
    O.oracle(
        """
        SELECT CASE kind WHEN 0 THEN 'bad_flight_date' WHEN 1 THEN 'no_airline' WHEN 2 THEN 'bad_distance' WHEN 3 THEN 'bad_arr_delay'
                         WHEN 4 THEN 'no_dest' WHEN 5 THEN 'fields_missing' WHEN 6 THEN 'fields_extra' ELSE 'accepted' END AS reason,
               CAST(SUM(copies) AS BIGINT) AS n
        FROM kinds GROUP BY 1
        UNION ALL SELECT 'delivered', CAST(SUM(copies) AS BIGINT) FROM kinds""",
        KIND_SQL,
    ),
)
def q_src1_rejects(spark, sf):
    """Every delivered record is accepted or rejected for a reason."""
    return RJ.counts_by_reason(RJ.tag_rejects(LA.read_mixed_csv(spark, broken_csv_folder(spark, sf), corrupt=True)))


@register(
    "src1_load_with_rejects",
    O.oracle(
        """
        SELECT 'curated' AS part, COUNT(*) AS n FROM kinds WHERE kind > 6
        UNION ALL SELECT 'duplicates', CAST(COALESCE(SUM(copies - 1), 0) AS BIGINT) FROM kinds WHERE kind > 6
        UNION ALL SELECT 'rejected', CAST(COALESCE(SUM(copies), 0) AS BIGINT) FROM kinds WHERE kind <= 6""",
        KIND_SQL,
    ),
)
def q_src1_load(spark, sf):
    """The curated table and the rejects beside it, read back: together they are what was delivered."""

    def make():
        source, curated, rejects = broken_csv_folder(spark, sf), work_dir(spark, "accepted"), work_dir(spark, "rejects")
        counts = RJ.load_with_rejects(LA.read_mixed_csv(spark, source, corrupt=True), curated, rejects, CURATED_COLUMNS)
        remove_folder(spark, source)
        return curated, rejects, counts

    curated, rejects, counts = _LOADS.get(
        spark, sf, "rejects", make, lambda s, made: [remove_folder(s, folder) for folder in made[:2]])
    written = [FS.read_curated(spark, curated).select(F.lit("curated").alias("part")),
               spark.read.parquet(rejects).select(F.lit("rejected").alias("part"))]
    duplicates = spark.range(counts["duplicates"]).select(F.lit("duplicates").alias("part"))
    rows = written[0].unionByName(written[1]).unionByName(duplicates)
    return rows.groupBy("part").agg(F.count(F.lit(1)).alias("n"))


BY_AIRLINE_SCHEMA = "airline string, avg_arr_delay double, n long"


@register(
    "src6_result_csv_scan",
    O.oracle("SELECT airline, AVG(arr_delay) AS avg_arr_delay, COUNT(*) AS n FROM flights GROUP BY airline"),
)
def q_src6(spark, sf):
    path = work_dir(spark, "by_airline_csv")
    W.write_result_csv(SU.delay_summary(flights(spark, sf), "airline"), path)
    return FS.read_result_csv(spark, path, BY_AIRLINE_SCHEMA)


@register("snk2_result_csv", None)
def q_snk2(spark, sf):
    path = work_dir(spark, "airport_on_time_csv")
    W.write_result_csv(S.run_sql(flights(spark, sf), S.airport_on_time(AIRPORT_MIN_FLIGHTS)), path)
    return FS.read_result_csv(spark, path, "airport string, num_flights long, on_time_rate double")


ORACLES["snk2_result_csv"] = ORACLES["sql4_airport_on_time"]


@register(
    "snk3_replay_files",
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
def q_snk3(spark, sf):
    plan = RP.replay_plan(flights(spark, sf), REPLAY_MONTHS, REPLAY_ROWS_PER_BATCH)
    path = work_dir(spark, "replay")
    W.write_replay_files(plan, path)
    back = (spark.read.option("header", True).schema(STREAM_SCHEMA).csv(path)
            .withColumn("flight_date", F.to_date("flight_date")))
    return RP.batch_profile(back)


@register(
    "flt5_recent_months_metadata",
    O.oracle("SELECT year, month, COUNT(*) AS n, SUM(arr_delay) AS sum_arr_delay FROM recent GROUP BY year, month", RECENT_SQL),
)
def q_flt5_metadata(spark, sf):
    """The newest months of the curated table, found without reading a column."""
    path = work_dir(spark, "curated")
    W.write_curated(IN.curated_projection(flights(spark, sf), CURATED_COLUMNS), path)
    recent = FS.read_recent_months(spark, path, REPLAY_MONTHS)
    return recent.groupBy("year", "month").agg(F.count(F.lit(1)).alias("n"), F.sum("arr_delay").alias("sum_arr_delay"))


# The month that the second load delivers (again, in full).
RELOADED = (1998, 3)


def loaded_states(spark: SparkSession, sf_dir: str) -> str:
    """States after two loads: all flights but two thirds of one month, then that month."""

    def make():
        curated, states = work_dir(spark, "loads"), work_dir(spark, "states")
        rows = IN.curated_projection(stored_flights(spark, sf_dir), CURATED_COLUMNS)
        late = PA.in_months([RELOADED])
        PA.load_months(rows.where(~late | (F.dayofmonth("flight_date") <= 10)), curated, states)
        PA.load_months(rows.where(late), curated, states)
        remove_folder(spark, curated)
        return states

    return _LOADS.get(spark, sf_dir, "states", make, remove_folder)


@register(
    "agg_summaries_from_states",
    O.oracle("""
        SELECT CASE GROUPING(airline, origin, dest, day_of_week) WHEN 7 THEN 'airline' WHEN 11 THEN 'origin' WHEN 13 THEN 'dest'
                    WHEN 9 THEN 'origin+dest' WHEN 14 THEN 'day_of_week' ELSE 'all' END AS grouping_set,
               airline, origin, dest, day_of_week, COUNT(*) AS n, round(AVG(arr_delay), 6) AS avg_arr_delay,
               round(stddev_samp(arr_delay), 6) AS sd_arr_delay, MIN(arr_delay) AS min_arr_delay, MAX(arr_delay) AS max_arr_delay,
               round(AVG(dep_delay), 6) AS avg_dep_delay
        FROM flights GROUP BY GROUPING SETS ((airline), (origin), (dest), (origin, dest), (day_of_week), ())"""),
)
def q_states(spark, sf):
    """Every summary table after two loads, from month states only."""
    states, united = spark.read.parquet(loaded_states(spark, sf)), None
    for dims in PA.DIMENSION_SETS:
        keys = [F.col(d) if d in dims else F.lit(None).cast("string").alias(d) for d in ("airline", "origin", "dest", "day_of_week")]
        part = PA.merged(states, list(dims)).select(
            F.lit(PA.set_name(dims)).alias("grouping_set"), *keys, "n", F.round("avg_arr_delay", 6).alias("avg_arr_delay"),
            F.round("sd_arr_delay", 6).alias("sd_arr_delay"), "min_arr_delay", "max_arr_delay", F.round("avg_dep_delay", 6).alias("avg_dep_delay"))
        united = part if united is None else united.unionByName(part)
    return united


@register("agg8_correlation_from_states", O.oracle("SELECT round(corr(distance, arr_delay), 6) AS corr FROM flights"))
def q_states_corr(spark, sf):
    return PA.correlation_from_states(spark.read.parquet(loaded_states(spark, sf))).select(F.round("corr", 6).alias("corr"))


def _day() -> F.Column:
    return F.dayofmonth("flight_date")


# Three deliveries that overlap, the last a repetition; (name, rows).
DELIVERIES = (("first", lambda: _day() <= 20), ("second", lambda: _day() > 10), ("again", lambda: _day() > 10))


def appended_loads(spark: SparkSession, sf_dir: str) -> tuple[str, list[tuple[str, int, int]]]:
    """The curated table after overlapping raw deliveries, and (load, delivered, added) of each."""

    def make():
        source, curated, parsed = raw_csv_folder(spark, sf_dir), work_dir(spark, "appended"), work_dir(spark, "parsed")
        # the deliveries are cuts of one feed, copies and all, whose text is parsed once
        feed = IN.arrived(IN.add_derived(IN.normalise(FS.read_raw_csv(spark, source))))
        IN.curated_projection(feed, CURATED_COLUMNS).write.parquet(parsed)
        remove_folder(spark, source)
        done = []
        for name, rows in DELIVERIES:
            made = AP.append_new(spark.read.parquet(parsed).where(rows()), curated)
            done.append((name, made.delivered, made.added))
        remove_folder(spark, parsed)
        return curated, done

    return _LOADS.get(spark, sf_dir, "appended", make, lambda s, made: remove_folder(s, made[0]))


@register("dst1_across_loads", O.oracle("SELECT * FROM flights"))
def q_dst1_across(spark, sf):
    """A table that overlapping and repeated loads were added to holds every flight once."""
    return FS.read_curated(spark, appended_loads(spark, sf)[0]).select(*CURATED_COLUMNS)


@register(
    "dst1_load_counts",
    O.oracle(
        """
        SELECT 'first' AS load, CAST(SUM(copies) AS BIGINT) AS delivered, COUNT(*) AS added FROM sent WHERE d <= 20
        UNION ALL SELECT 'second', CAST(SUM(copies) AS BIGINT), COUNT(*) FILTER (WHERE d > 20) FROM sent WHERE d > 10
        UNION ALL SELECT 'again', CAST(SUM(copies) AS BIGINT), 0 FROM sent WHERE d > 10""",
        """sent AS (SELECT day(flight_date) AS d, CASE WHEN l_orderkey % 100 = 0 THEN 2 ELSE 1 END AS copies
                    FROM base WHERE l_partkey % 50 <> 0)""",
    ),
)
def q_dst1_counts(spark, sf):
    """What each load delivered and what it added."""
    return spark.createDataFrame(appended_loads(spark, sf)[1], "load string, delivered long, added long")


def loaded_sketches(spark: SparkSession, sf_dir: str) -> str:
    """Month sketches after two loads, the second of one month."""

    def make():
        curated, sketches = work_dir(spark, "sketched"), work_dir(spark, "sketches")
        rows = IN.curated_projection(stored_flights(spark, sf_dir), CURATED_COLUMNS)
        late = PA.in_months([RELOADED])
        W.write_curated(rows.where(~late | (F.dayofmonth("flight_date") <= 10)), curated)
        SK.refresh_sketches(spark, curated, sketches)
        W.write_curated(rows.where(late), curated, only_written=True)
        SK.refresh_sketches(spark, curated, sketches, [RELOADED])
        remove_folder(spark, curated)
        return sketches

    return _LOADS.get(spark, sf_dir, "sketches", make, remove_folder)


@register(
    "agg7_quantiles_from_sketches",
    O.oracle(
        "\nUNION ALL\n".join(
            f"SELECT '{m}' AS measure, {p}::DOUBLE AS p, COUNT({m}) AS n, "
            + (f"{'MIN' if p == 0 else 'MAX'}({m})" if p in (0, 1) else "NULL") + " AS extreme, TRUE AS within_bound FROM flights"
            for m in SK.MEASURES for p in SK.QUARTILES)),
)
def q_sketches(spark, sf):
    """Quartiles of every measure from month sketches; whether their true ranks keep the bound; the ends are exact."""
    found = SK.quantiles(spark.read.parquet(loaded_sketches(spark, sf)))
    ranked = SK.rank_shares(flights(spark, sf), found)
    error = SK.rank_error(F.col("p"), F.col("below"), F.col("upto"))
    return ranked.select("measure", "p", "n", F.when(F.col("p").isin(0.0, 1.0), F.col("value")).alias("extreme"),
                         (error <= SK.RANK_ERROR).alias("within_bound"))
