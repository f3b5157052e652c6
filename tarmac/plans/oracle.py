"""Independent DuckDB SQL for the registered queries (the correctness oracle).

The same flight mapping as ``tarmac.sources.fixtures`` written once as SQL CTEs
(``base`` -> ``cleaned`` -> ``flights``) over the pre-registered test tables.
Each oracle is ``WITH <flight CTEs>[, extra CTEs] <select>``.
"""

from __future__ import annotations

FLIGHT_CTES = """
base AS (
    SELECT l.l_orderkey, l.l_partkey, l.l_linenumber, l.l_quantity, l.l_extendedprice,
           CAST(l.l_shipdate AS DATE) AS flight_date,
           p.p_brand AS airline, ns.n_name AS origin, nc.n_name AS dest
    FROM lineitem l
    JOIN orders o    ON l.l_orderkey = o.o_orderkey
    JOIN customer c  ON o.o_custkey = c.c_custkey
    JOIN nation nc   ON c.c_nationkey = nc.n_nationkey
    JOIN part p      ON l.l_partkey = p.p_partkey
    JOIN supplier s  ON l.l_suppkey = s.s_suppkey
    JOIN nation ns   ON s.s_nationkey = ns.n_nationkey
),
cleaned AS (
    SELECT flight_date, airline, origin, dest,
           CASE WHEN l_partkey % 50 = 0 THEN chr(CAST(65 + l_orderkey % 3 AS INTEGER)) END
               AS cancellation_code,
           CASE WHEN l_partkey % 50 <> 0 THEN l_quantity + l_partkey % 7 - 14 END AS arr_delay,
           l_quantity - 10 AS dep_delay,
           l_extendedprice / 100 AS distance,
           CAST((l_orderkey % 24) * 100 + (l_linenumber * 7) % 60 AS INTEGER) AS crs_dep_time,
           CAST(floor(((l_orderkey % 24) * 100 + (l_linenumber * 7) % 60) / 100) AS INTEGER)
               AS dep_hour,
           CAST(year(flight_date) AS INTEGER) AS year,
           CAST(month(flight_date) AS INTEGER) AS month,
           strftime(flight_date, '%a') AS day_of_week
    FROM base
),
flights AS (
    SELECT * FROM cleaned
    WHERE flight_date IS NOT NULL AND airline IS NOT NULL AND origin IS NOT NULL
      AND dest IS NOT NULL AND arr_delay IS NOT NULL
)"""


def oracle(select: str, extra_ctes: str = "") -> str:
    """Full DuckDB statement: flight CTEs, optional extra CTEs, final select."""
    extra = f",\n{extra_ctes.strip().rstrip(',')}" if extra_ctes.strip() else ""
    return f"WITH {FLIGHT_CTES.strip()}{extra}\n{select.strip()}"


def half_up_rate(numerator: str, denominator: str, decimals: int = 5) -> str:
    """numerator / denominator rounded half-up to ``decimals`` places, exactly.

    Integer arithmetic, then one correctly rounded division, which is what a
    decimal average cast to double gives in Spark.
    """
    scale = 10 ** decimals
    return (f"CAST((2 * {scale} * ({numerator}) + ({denominator})) // (2 * ({denominator})) AS DOUBLE)"
            f" / {scale}")
