"""Plan-shape guards for every registered query (static plans, AQE off)."""

import re

import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def static(spark):
    old = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield spark
    spark.conf.set("spark.sql.adaptive.enabled", old)


@pytest.mark.parametrize("name", sorted(E.queries()))
def test_plan_shape(static, name):
    plan = E.queries()[name](static, SF)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "BatchEvalPython" not in plan  # no row-at-a-time Python UDFs
    assert plan.count("ArrowEvalPython") <= 1  # only the exact entity decoder
    # every hash aggregation that feeds an exchange aggregates map-side first
    finals = len(re.findall(r"HashAggregate\(keys=\[[^\]]*\], functions=\[(?!partial_)[a-z]", plan))
    partials = len(re.findall(r"functions=\[partial_", plan))
    assert partials >= finals or finals == 0
