"""Every registered query with SQL equals DuckDB on the smallest tables."""

import pytest
from compare import assert_same, connect

from segloom import queries as q


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


@pytest.mark.parametrize("name", sorted(q.ORACLES))
def test_query_equals_sql(spark, sf, con, name):
    assert_same(q.QUERIES[name](spark, sf), con, q.ORACLES[name])


def test_reprojection_and_back(spark, sf):
    rows = q.QUERIES["reproject"](spark, sf).collect()
    assert rows
    assert all(abs(r["dx"]) < 1e-7 and abs(r["dy"]) < 1e-7 for r in rows)


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
