"""Every registered query with an oracle equals it; the others yield rows."""

import os
import re

import pytest

import __spark_entry__ as entry_module
from oracle import connect, oracle_table, spark_table

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")
# The corpus operators have tests of their own.
QUERIES = {n: q for n, q in entry_module.queries().items() if not re.match(r"op\d+_|pipeline$", n)}
ORACLES = {n: q for n, q in entry_module.oracle_sql().items() if n in QUERIES}

# No query may pair all rows of two tables or leave the JVM.
UNWANTED = ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "MapInPandas", "FlatMapGroupsInPandas")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF_DIR)
    result = spark_table(df)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [bad for bad in UNWANTED if bad in plan]
    if name not in ORACLES:
        assert result[0]
        return
    expected = oracle_table(con, ORACLES[name])
    assert result[0] == expected[0]
    assert len(result[1]) == len(expected[1])
    assert expected[1], "the oracle is empty, so the check says nothing"
    for got, want in zip(result[1], expected[1]):
        assert got == want


def test_oracles_name_known_queries():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    assert entry_module.entry(spark).count() == 1
