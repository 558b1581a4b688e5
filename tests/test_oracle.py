"""Every registered query against its SQL twin."""

import pytest
from oracle import DATA, connect, differences

import __spark_entry__ as contract
from millrace.workload import REGISTRY

SF_DIR = str(DATA / "sf0.001")
# The queries of the training-data operators have their own tests in tests/llm.
QUERIES = {name: run for name, run in contract.queries().items() if name in REGISTRY}
ORACLES = {name: sql for name, sql in contract.oracle_sql().items() if name in REGISTRY}


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, con, name):
    assert differences(QUERIES[name](spark, SF_DIR), con, ORACLES[name]) == []


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_without_sql_runs(spark, name):
    assert QUERIES[name](spark, SF_DIR).count() > 0


def test_entry_runs(spark):
    assert contract.entry(spark).count() == 1500


@pytest.mark.parametrize("name", ["fct_orders", "dim_customers", "metrics_daily"])
def test_result_does_not_depend_on_partitions(spark, con, name):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert differences(QUERIES[name](spark, SF_DIR), con, ORACLES[name]) == []
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("name", sorted(set(QUERIES)))
def test_no_plan_joins_every_pair(spark, name):
    plan = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
    assert "PythonUDF" not in plan and "ArrowEvalPython" not in plan
