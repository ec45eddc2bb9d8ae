"""Registered queries of the subpackage against their SQL."""

import pytest

import __spark_entry__ as registry
from check import canonical, oracle_rows
from riskmart.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.01"


def test_every_operator_and_the_pipeline_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert {*QUERIES, "pipeline"} <= set(registry.queries()) and set(ORACLES) <= set(registry.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, name):
    df = QUERIES[name](spark, SF)
    got = canonical(df.columns, [tuple(r) for r in df.collect()])
    columns, rows, _ = oracle_rows(SF, ORACLES[name])
    assert got == canonical(columns, rows)


@pytest.mark.parametrize("name", ["op6_quality_rules", "op8_chat_format"])
def test_native_queries_run_no_python(spark, name):
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas", "ExistingRDD"))
