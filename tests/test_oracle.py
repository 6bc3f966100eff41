"""Every registered query against its SQL on the smallest test tables."""

import os

import pytest
from oracle import compare, connect

from __spark_entry__ import entry, oracle_sql, queries
from tillstar.plans import QUERIES

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
SQL = oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = connect(SF_DIR)
    yield con
    con.close()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(name, spark, duck):
    df = queries()[name](spark, SF_DIR)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    if name in SQL:
        assert compare(df, duck, SQL[name]) == []
    else:
        df.count()


def test_every_query_has_sql():
    assert set(QUERIES) <= set(SQL)


def test_entry_returns_the_elite(spark):
    assert entry(spark).columns[0] == "posicao"
