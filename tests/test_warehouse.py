"""The loaded warehouse answers every OLAP query exactly as the raw star."""

import pytest
from pyspark.sql import functions as F

from shelfwise.plans import queries as Q
from shelfwise.plans.catalog import OLAP
from shelfwise.plans.warehouse import WarehouseStar, load_warehouse
from tests.helpers import digest, plan_text


@pytest.fixture(scope="module")
def warehouse(spark, star):
    from shelfwise.session import new_scratch
    root = new_scratch(spark, "warehouse")
    counts = load_warehouse(star, root)
    return WarehouseStar(spark, root), counts


def test_load_counts(warehouse):
    _, counts = warehouse
    assert counts["time_dim"] == 60000 and counts["sales_fact"] == 60000
    assert counts["customer_dim"] == 1500 and counts["store_dim"] == 25


@pytest.mark.parametrize("name", sorted(OLAP))
def test_same_answer(star, warehouse, name):
    wh, _ = warehouse
    fn = getattr(Q, name)
    a, b = fn(star), fn(wh)
    assert a.columns == b.columns
    ra, rb = [tuple(r) for r in a.collect()], [tuple(r) for r in b.collect()]
    assert digest(a.columns, ra) == digest(b.columns, rb)


def test_year_is_partition_pruned(warehouse):
    wh, _ = warehouse
    plan = plan_text(Q.q4_quarter_pivot(wh))
    assert "PartitionFilters: [isnotnull(year" in plan and "(year#" in plan


def test_fact_total(warehouse):
    wh, _ = warehouse
    from decimal import Decimal
    assert wh.sales_fact.agg(F.sum("total_sale")).first()[0] == Decimal("1447849638.00")
