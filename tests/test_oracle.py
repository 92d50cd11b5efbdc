"""Every registered query with SQL equals DuckDB on the sf0.001 tables.

The same comparison the driver runs at sf0.01: column names, row count and
the order-insensitive multiset of values (doubles compared exactly).
"""

import os
import sys

import pytest

from helpers import SF_SMALL

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))
import oracle_check  # noqa: E402

import __spark_entry__ as E  # noqa: E402
from zonecast.plans import catalog  # noqa: E402

# The training-data operators have tests of their own in tests/llm.
NAMES = sorted(n for n in E.oracle_sql() if n in catalog.QUERIES)


@pytest.fixture(scope="module")
def con():
    import duckdb
    c = duckdb.connect()
    for name in oracle_check.TABLES:
        c.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{SF_SMALL}/{name}.parquet')")
    return c


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_duckdb(spark, con, name):
    s = E.queries()[name](spark, SF_SMALL).toPandas()
    d = con.execute(E.oracle_sql()[name]).df()
    assert sorted(s.columns) == sorted(d.columns)
    assert len(s) == len(d)
    exact = oracle_check.EXACT
    oracle_check.EXACT = True
    try:
        assert oracle_check._rows(s) == oracle_check._rows(d)
    finally:
        oracle_check.EXACT = exact
