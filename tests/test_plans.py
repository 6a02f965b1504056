"""Plan shapes that matter at scale."""

import pytest

import __spark_entry__ as E
from tests.conftest import SF001
from tests.helpers import plan_text

OLAP = ["q1_supplier_drilldown", "q2_rollup_compat", "q2_grouping_sets", "q3_weekend_top5",
        "q4_quarter_pivot", "q5_sigma_anomaly", "q6_store_product_mv", "q6_line",
        "q7_store_slice", "q7_line", "q8_supplier_month_mv", "q9_compat", "q9_line",
        "q10_entity_month_mv_compat", "q10_entity_month_mv_line"]


@pytest.mark.parametrize("name", OLAP)
def test_no_cross_join_no_python_no_global_window(spark, name):
    df = E.queries()[name](spark, SF001)
    plan = plan_text(df)
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython",
                "ArrowEvalPython", "Window"):
        assert bad not in plan, bad


@pytest.mark.parametrize("name", ["q2_rollup_compat", "q4_quarter_pivot", "q9_line"])
def test_year_filter_reaches_the_scan(spark, name):
    plan = plan_text(E.queries()[name](spark, SF001))
    assert "GreaterThanOrEqual(o_orderdate,1997-01-01T00:00)" in plan
    assert "LessThan(o_orderdate,1998-01-01T00:00)" in plan


def test_scan_is_pruned(spark):
    plan = plan_text(E.queries()["q4_quarter_pivot"](spark, SF001))
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_quantity:double>" in plan


def test_lines_are_aggregated_before_the_product_join(spark):
    plan = plan_text(E.queries()["q1_supplier_drilldown"](spark, SF001))
    assert "partial_sum(qty" in plan


def test_first_wins_has_partial_step(spark):
    plan = plan_text(E.queries()["dim_customer"](spark, SF001))
    assert "Window" not in plan
    assert plan.count("SortAggregate") + plan.count("HashAggregate") >= 2


@pytest.mark.parametrize("name", ["q2_rollup_compat", "q2_grouping_sets", "q6_store_product_mv",
                                  "q7_store_slice", "q7_line"])
def test_lines_are_reduced_below_the_first_aggregate(spark, name):
    """The semi-join with the chosen products stands under the partial sum of lines."""
    plan = E.queries()[name](spark, SF001)._jdf.queryExecution().optimizedPlan().toString()
    assert "sum(qty" in plan and "Join LeftSemi" in plan
    assert plan.index("sum(qty") < plan.index("Join LeftSemi")
