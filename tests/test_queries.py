"""Every registered query against its SQL, and what its plan must not hold."""

import os

import pytest

import __spark_entry__ as registry
from check import canonical, oracle_rows
from riskmart.plans.oracles import ORACLES
from riskmart.plans.queries import QUERIES

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def test_every_query_has_sql_and_is_registered():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(registry.queries()) and set(ORACLES) <= set(registry.oracle_sql())


def test_entry(spark):
    assert registry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, name):
    df = QUERIES[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for unwanted in ("PythonUDF", "BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert unwanted not in plan
    got = canonical(df.columns, [tuple(r) for r in df.collect()])
    columns, rows, _ = oracle_rows(SF, ORACLES[name])
    assert got == canonical(columns, rows)
