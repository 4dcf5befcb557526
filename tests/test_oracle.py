"""Every query with oracle SQL must agree with DuckDB on columns, types and values."""

import pytest

import __spark_entry__ as entry
from oracle import all_sql
from oracle.compare import compare, connect
from tests.conftest import SMALL
from tillwork.registry import QUERIES

SQL = all_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


def test_every_oracle_has_a_query():
    assert not set(SQL) - set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_agrees_with_sql(spark, con, name):
    assert compare(QUERIES[name](spark, SMALL), con, SQL[name]) == ""


@pytest.mark.parametrize("name", sorted(
    n for n in set(QUERIES) - set(SQL) if not n.startswith(("m1_", "m3_"))))
def test_gives_rows(spark, name):
    assert QUERIES[name](spark, SMALL).count() > 0


def test_entry(spark):
    assert entry.entry(spark).columns[:2] == ["category", "order_month"]
