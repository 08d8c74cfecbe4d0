"""Every query that has SQL gives the SQL's rows, on the smallest driver tables."""

from pathlib import Path

import pytest
from parity import connect, difference

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="no driver tables")


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, con, name):
    df = entry.queries()[name](spark, SF)
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert df.count() > 0
    else:
        assert difference(df, con, sql) is None


def test_sql_only_for_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    rows = entry.entry(spark).collect()
    assert rows and rows[0].asDict().keys() >= {"MODEL_YEAR", "CUMULATIVE_COUNT", "PCT_OF_GOAL"}
