"""Spark SQL analyses over a ``flights`` view.

One builder writes a grouped query from dimensions, measures, a minimum group size,
an order and a top-k; the analyses are settings of it.  The texts are plain SQL, so an
analyst can run them in any Spark SQL client; ``run_sql`` registers the view and
returns the (lazy) result.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame

VIEW = "flights"
ROWS = "num_flights"


def mean(column: str) -> str:
    return f"AVG({column})"


def share_at_most(column: str, bound: float) -> str:
    """Share of rows at or below a bound: a decimal average (5 places, rounded exactly), as double."""
    return f"CAST(AVG(CASE WHEN {column} <= {bound} THEN 1.0 ELSE 0.0 END) AS DOUBLE)"


def grouped_sql(
    dimensions: Sequence[str] | Mapping[str, str],
    measures: Mapping[str, str],
    order: Sequence[str] = (),
    min_rows: int | None = None,
    top_k: int | None = None,
    view: str = VIEW,
) -> str:
    """SELECT of dimensions, row count and measures per group.

    ``dimensions`` are columns, or output name -> column; ``measures`` output name ->
    aggregate; ``order`` items are output names, "-" in front for descending.  Ties are
    broken by the dimensions, so an ordered or limited result is repeatable.
    """
    dims = dict(dimensions) if isinstance(dimensions, Mapping) else {d: d for d in dimensions}
    outputs = [f"{c} AS {name}" for name, c in dims.items()] + [f"COUNT(*) AS {ROWS}"]
    outputs += [f"{expression} AS {name}" for name, expression in measures.items()]
    clauses = [f"SELECT {', '.join(outputs)}", f"FROM {view}", f"GROUP BY {', '.join(dims.values())}"]
    if min_rows is not None:
        clauses.append(f"HAVING COUNT(*) >= {int(min_rows)}")
    keys = [f"{o[1:]} DESC" if o.startswith("-") else o for o in order]
    keys += [d for d in dims if d not in {o.lstrip("-") for o in order}]
    clauses.append(f"ORDER BY {', '.join(keys)}")
    if top_k is not None:
        clauses.append(f"LIMIT {int(top_k)}")
    return "\n".join(clauses)


def by_airline(view: str = VIEW) -> str:
    means = {f"avg_{m}": mean(m) for m in ("arr_delay", "dep_delay")}
    return grouped_sql(["airline"], means, order=["-avg_arr_delay"], view=view)


def by_month(view: str = VIEW) -> str:
    return grouped_sql(["year", "month"], {"avg_arr_delay": mean("arr_delay")}, view=view)


def by_route(min_flights: int = 500, top_k: int = 20, view: str = VIEW) -> str:
    return grouped_sql(
        ["origin", "dest"], {"avg_arr_delay": mean("arr_delay")}, order=["-avg_arr_delay"],
        min_rows=min_flights, top_k=top_k, view=view,
    )


def airport_on_time(min_flights: int = 1000, on_time_minutes: float = 15, view: str = VIEW) -> str:
    return grouped_sql(
        {"airport": "origin"}, {"on_time_rate": share_at_most("arr_delay", on_time_minutes)},
        order=["-on_time_rate"], min_rows=min_flights, view=view,
    )


def run_sql(flights: DataFrame, sql: str, view: str = VIEW) -> DataFrame:
    """Register ``flights`` as ``view`` and run ``sql`` on it."""
    flights.createOrReplaceTempView(view)
    return flights.sparkSession.sql(sql)
