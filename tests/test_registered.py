"""Every registered query against its SQL on the smallest tables."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from catalog import all_queries, all_sql
from compare import connect, difference
from conftest import SMALL

QUERIES, SQL = all_queries(), all_sql()


@pytest.fixture(scope="module")
def connection():
    return connect(SMALL)


@pytest.mark.parametrize("name", QUERIES)
def test_query_matches_sql(spark, connection, name):
    assert difference(spark, connection, SMALL, QUERIES[name], SQL[name]) == ""


def test_every_query_has_sql_and_is_in_the_entry():
    assert set(SQL) == set(QUERIES)
    assert set(QUERIES) <= set(queries()) and set(SQL) <= set(oracle_sql()) <= set(queries())


def test_entry_has_rows(spark):
    frame = entry(spark)
    assert frame.limit(1).count() == 1
    assert {"composite_aqi", "dominant_pollutant", "health_category"} <= set(frame.columns)
