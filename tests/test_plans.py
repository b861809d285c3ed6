"""Layer 4: plan shape - no cartesian products, no Python in the feature
queries, fixed code tables broadcast, filters pushed to the scan."""

import pytest

from role_cases import SF0001
from churnlens.operators import tasks
from churnlens.plans import customer, customer_product
from churnlens.rules import DRIVER_RULES
from churnlens.sources.roles import driver_roles


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("active", [False, True])
def test_feature_queries_plan_shape(spark, active):
    roles = driver_roles(spark, SF0001)
    for df in (
        customer.customer_features(roles, DRIVER_RULES, active_only=active),
        customer_product.customer_product_features(roles, DRIVER_RULES, active_only=active),
    ):
        p = plan(df)
        assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p
        assert "EvalPython" not in p and "ArrowEvalPython" not in p and "MapInPandas" not in p


def test_status_table_is_broadcast_and_filters_pushed(spark):
    roles = driver_roles(spark, SF0001)
    df = tasks.product_tasks(roles, DRIVER_RULES)
    p = df._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in p or "BroadcastExchange" in p
    pushed = [line for line in p.splitlines() if "PushedFilters" in line]
    assert any("IsNotNull(l_returnflag)" in line or "IsNotNull(l_orderkey)" in line for line in pushed)


def _scans(df, column):
    """Scans of the executed plan, before adaptive execution, that read ``column``."""
    return sum("FileScan" in line and column in line for line in plan(df).splitlines())


@pytest.mark.parametrize("active", [False, True])
def test_tasks_are_read_once(spark, active):
    roles = driver_roles(spark, SF0001)
    df = customer.customer_features(roles, DRIVER_RULES, active_only=active)
    assert _scans(df, "l_orderkey") <= 4
    assert "Union" not in plan(df)
    assert ("LeftSemi" in plan(df)) == active


def test_scan_prunes_columns(spark):
    roles = driver_roles(spark, SF0001)
    df = customer.customer_features(roles, DRIVER_RULES)
    p = plan(df)
    # the order table is read for key, customer, status, date and priority only
    assert "o_totalprice" not in p
