"""Flight-shaped data derived from the provided star-schema test tables.

The test tables hold no flights, so one deterministic mapping turns every
``lineitem`` row into one flight (see FIXTURES.md §5):

    flight_date       = date of l_shipdate
    airline           = p_brand
    origin / dest     = nation name of the supplier / of the ordering customer
    dep_delay         = l_quantity - 10
    arr_delay         = l_quantity + l_partkey % 7 - 14     (NULL when cancelled)
    distance          = l_extendedprice / 100
    crs_dep_time      = (l_orderkey % 24) * 100 + (l_linenumber * 7) % 60
    cancellation_code = A/B/C by l_orderkey % 3 when l_partkey % 50 = 0

Everything is a Spark plan over the given tables, so the work grows with them.

Join plan: lineitem is the fact table and is joined on three different keys
(suppkey, orderkey, partkey), so each join that is not a broadcast join is a shuffle of the fact
stream; every input is pruned to the few columns it contributes before joining.  The
supplier comes first, as a table and not as a join, so that its size in bytes is known when the join is
planned; nations travel as keys and get their names last.
Which side is broadcast, if any, is left to byte statistics and AQE: no hints, so
``spark.sql.autoBroadcastJoinThreshold`` holds, and larger joins are sort-merge joins
whose hot keys AQE's skew-join handling splits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.functions.columns import hhmm_to_hour, weekday_label
from tarmac.session import Fixtures, remove_folder, shuffles_removed, work_dir

_STORED = Fixtures(keep=8)


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def _base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem joined to the names it needs: one row per lineitem row.

    The dimensions' sizes in bytes decide which joins are broadcast joins.
    """
    lineitem = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
        "l_quantity", "l_extendedprice", F.to_date("l_shipdate").alias("flight_date"),
    )
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    customer = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    supplier = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    part = read_table(spark, sf_dir, "part").select("p_partkey", F.col("p_brand").alias("airline"))
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")

    origins = nation.select(F.col("n_nationkey").alias("_origin_key"), F.col("n_name").alias("origin"))
    dests = nation.select(F.col("n_nationkey").alias("_dest_key"), F.col("n_name").alias("dest"))
    nation_of_order = orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "c_nationkey")

    return (
        lineitem
        .join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(nation_of_order, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(part, F.col("l_partkey") == F.col("p_partkey"))
        .join(origins, F.col("s_nationkey") == F.col("_origin_key"))
        .join(dests, F.col("c_nationkey") == F.col("_dest_key"))
        .select(
            "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice",
            "flight_date", "airline", "origin", "dest",
        )
    )


def _cancelled() -> Column:
    return F.col("l_partkey") % 50 == 0


def _cancellation_code() -> Column:
    return F.when(_cancelled(), F.char(F.lit(65) + F.col("l_orderkey") % 3))


def _arr_delay() -> Column:
    return F.when(~_cancelled(), F.col("l_quantity") + F.col("l_partkey") % 7 - 14)


def _dep_delay() -> Column:
    return F.col("l_quantity") - 10


def _distance() -> Column:
    return F.col("l_extendedprice") / 100


def _crs_dep_time() -> Column:
    return ((F.col("l_orderkey") % 24) * 100 + (F.col("l_linenumber") * 7) % 60).cast("int")


def flights_cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed, trimmed flights including cancelled ones (arr_delay NULL there)."""
    b = _base(spark, sf_dir)
    return b.select(
        "flight_date", "airline", "origin", "dest",
        _cancellation_code().alias("cancellation_code"),
        _arr_delay().alias("arr_delay"),
        _dep_delay().alias("dep_delay"),
        _distance().alias("distance"),
        _crs_dep_time().alias("crs_dep_time"),
        hhmm_to_hour(_crs_dep_time()).alias("dep_hour"),
        F.year("flight_date").alias("year"),
        F.month("flight_date").alias("month"),
        weekday_label("flight_date").alias("day_of_week"),
    )


def flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 'arrived' flights: rows usable for delay analytics (no NULL keys/delay)."""
    from tarmac.operators.ingest import arrived

    return arrived(flights_cleaned(spark, sf_dir))


def stored_flights_folder(spark: SparkSession, sf_dir: str) -> str:
    """``flights`` written as Parquet once per session and state of the data.

    Jobs that go over the flights several times (fits, replays, loads) read this folder, so the
    joins and their shuffles run once.
    """

    def make():
        path = work_dir(spark, "flights")
        with shuffles_removed(spark):
            flights(spark, sf_dir).write.parquet(path)
        return path

    return _STORED.get(spark, sf_dir, "flights", make, remove_folder)


def stored_flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of ``flights`` from their stored form."""
    return spark.read.parquet(stored_flights_folder(spark, sf_dir))


def raw_flights_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same flights as dirty raw text, as a CSV export would deliver them.

    Dirt, all deterministic: three date layouts (chosen by l_orderkey % 3),
    blank-padded carrier / airport / cancellation codes, HHMM times with and
    without leading zeros, delays as text with 'NA' or empty for cancelled
    flights, and every row of every 100th order delivered twice.  Cleaning it
    must give back exactly ``flights_cleaned``.
    """
    b = _base(spark, sf_dir)
    d = F.col("flight_date")
    layout = F.col("l_orderkey") % 3
    fl_date = (
        F.when(layout == 0, F.date_format(d, "yyyy-MM-dd"))
        .when(layout == 1, F.date_format(d, "M/d/yyyy"))
        .otherwise(F.date_format(d, "MM/dd/yyyy"))
    )

    def padded(c: str, odd: Column) -> Column:
        return F.when(odd, F.concat(F.lit(" "), F.col(c), F.lit("  "))).otherwise(F.col(c))

    odd_line = F.col("l_linenumber") % 2 == 1
    odd_order = F.col("l_orderkey") % 2 == 1
    hhmm = _crs_dep_time().cast("string")
    copies = F.when(F.col("l_orderkey") % 100 == 0, F.lit(2)).otherwise(F.lit(1))
    return b.select(
        fl_date.alias("FL_DATE"),
        padded("airline", odd_line).alias("AIRLINE"),
        padded("origin", odd_order).alias("ORIGIN"),
        padded("dest", ~odd_order).alias("DEST"),
        F.when(odd_line, hhmm).otherwise(F.lpad(hhmm, 4, "0")).alias("CRS_DEP_TIME"),
        _dep_delay().cast("string").alias("DEP_DELAY"),
        F.when(_cancelled(), F.when(~odd_order, F.lit("NA")))
        .otherwise(_arr_delay().cast("string")).alias("ARR_DELAY"),
        F.concat(_cancellation_code(), F.lit(" ")).alias("CANCELLATION_CODE"),
        _distance().cast("string").alias("DISTANCE"),
        F.explode(F.sequence(F.lit(1), copies)).alias("_copy"),
    ).drop("_copy")
