"""Every registered query against its SQL at the smallest scale."""

from __future__ import annotations

import pytest

import __spark_entry__ as registry
from check_oracle import actual, connect, expected

SF = "/root/testdata/sf0.001"
# The queries of optional modules have tests of their own.
OWN = registry._queries()
QUERIES = {name: query for name, query in registry.queries().items() if name in OWN}
SQL = {name: sql for name, sql in registry.oracle_sql().items() if name in OWN}


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_sql_has_a_query():
    assert set(SQL) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, con, name):
    got = actual(QUERIES[name](spark, SF))
    want = expected(con, SQL[name])
    assert got[0] == want[0]
    assert got[1] == want[1]


def test_entry(spark):
    assert registry.entry(spark).count() == 200
