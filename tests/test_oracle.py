"""Every query with an oracle agrees with DuckDB on sf0.001 (names, rows, values)."""

import pytest

import __spark_entry__ as E
from tools.oracle_check import rows_of

from conftest import SF_SMALL

ORACLES = E.oracle_sql()
QUERIES = E.queries()


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["airline", "num_flights", "avg_arr_delay", "avg_dep_delay"]


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF_SMALL)
    cols, recs = df.columns, [tuple(r) for r in df.collect()]
    res = duck.execute(ORACLES[name])
    ocols, orecs = [d[0] for d in res.description], res.fetchall()
    assert sorted(cols) == sorted(ocols)
    assert len(recs) == len(orecs)
    assert rows_of(cols, recs) == rows_of(ocols, orecs)
