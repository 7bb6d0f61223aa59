"""Every registered query against its SQL, or against its own invariants."""

import pytest

import __spark_entry__ as entry
from check import connect, differences

SQL = entry.oracle_sql()
QUERIES = entry.queries()


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


def test_flagship_runs(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, con, sf, name):
    problems, _ = differences(spark, con, name, sf)
    assert problems == []


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_query_without_sql_returns_rows(spark, sf, name):
    assert QUERIES[name](spark, sf).count() > 0
