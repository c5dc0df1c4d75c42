"""Every registered claims query against independent SQL on the same tables."""

import pytest
from compare import connect, spark_rows, sql_rows

import __spark_entry__ as entry_point
from claimgauge.plans.registered import registered
from oracle.queries import oracle_queries

QUERIES, SQL = registered(), oracle_queries()


@pytest.fixture(scope="module")
def con(small_dir):
    return connect(small_dir)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry_point.queries()) and set(SQL) <= set(entry_point.oracle_sql())


@pytest.mark.parametrize("name", QUERIES)
def test_equal(spark, con, small_dir, name):
    assert spark_rows(QUERIES[name](spark, small_dir)) == sql_rows(con, SQL[name])


def test_entry(spark):
    assert entry_point.entry(spark).limit(1).count() == 1
