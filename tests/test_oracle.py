"""Every registered query with a SQL twin gives the same rows in both engines."""

import pytest

import __spark_entry__ as entry
from compare import compare, connect

ORACLES = entry.oracle_sql()
QUERIES = entry.queries()


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, con, sf, name):
    assert compare(spark, con, sf, QUERIES[name], ORACLES[name]) is None


def test_twins_belong_to_queries():
    assert set(ORACLES) <= set(QUERIES)


def test_entry_has_rows(spark):
    df = entry.entry(spark)
    assert {"model", "h", "MAE", "sMAPE"} <= set(df.columns)
    assert df.count() == 21
