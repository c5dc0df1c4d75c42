"""Registered queries against their SQL, over whole small tables."""

import pytest
from compare import connect, spark_rows, sql_rows

from claimgauge.llm import registered

SQL = registered.oracle_sql()


def test_every_operator_is_registered_once():
    numbers = sorted(int(name[2:].split("_")[0]) for name in registered.queries())
    assert numbers == list(range(1, 14)) and SQL.keys() <= registered.queries().keys()


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_its_sql(spark, sf_dir, name):
    assert spark_rows(registered.queries()[name](spark, sf_dir)) == sql_rows(connect(sf_dir), SQL[name])
