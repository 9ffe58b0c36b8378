"""Registered queries against their SQL on the smallest tables."""

import pytest

import __spark_entry__
from workload.compare import compare, connect

QUERIES, SQL = __spark_entry__.queries(), __spark_entry__.oracle_sql()
SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


def test_every_check_belongs_to_a_query():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_gives_the_rows_of_its_sql(spark, con, name):
    verdict, _ = compare(spark, con, SMALL, name, QUERIES, SQL)
    assert verdict.startswith(("ok", "rows-only"))
