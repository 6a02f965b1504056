"""Invariants of the warehouse."""

from decimal import Decimal

import pytest

from pyspark.sql import functions as F

from shelfwise.plans import fact, queries as Q
from shelfwise.plans.aggregates import AggregateTable, order_slices
from shelfwise.sources.star import build_star


def test_line_fact_total(star):
    total = fact.fact_load_line(star).agg(F.sum("total_sale")).first()[0]
    assert total == Decimal("1447849638.00")


def test_line_fact_equals_qty_times_price(star):
    lines = star.lines.join(star.product, "product_id")
    direct = lines.agg(F.sum(F.col("qty") * F.col("price"))).first()[0]
    assert direct == Decimal("1447849638.00")


def test_drill_down_levels_add_up(star):
    months = Q.q1_supplier_drilldown(star, 3)
    quarters = Q.q1_supplier_drilldown(star, 2)
    years = Q.q1_supplier_drilldown(star, 1)
    a = months.groupBy("supplier_id", "year", "quarter").agg(F.sum("total_sales").alias("m"))
    b = quarters.join(a, ["supplier_id", "year", "quarter"])
    assert b.where(F.col("m") != F.col("total_sales")).count() == 0
    assert b.count() == quarters.count()
    tot = [d.agg(F.sum("total_sales")).first()[0] for d in (months, quarters, years)]
    assert tot[0] == tot[1] == tot[2]


def test_quarters_sum_to_year(star):
    q4 = Q.q4_quarter_pivot(star)
    bad = q4.where(F.col("q1") + F.col("q2") + F.col("q3") + F.col("q4") != F.col("yearly_total"))
    assert bad.count() == 0


def test_q4_revenue_measure(star):
    rev = Q.q4_quarter_pivot(star, measure="revenue")
    assert rev.where(F.col("q1") + F.col("q2") + F.col("q3") + F.col("q4")
                     != F.col("yearly_total")).count() == 0


def test_rollup_grand_total_is_sum_of_leaves(star):
    r = Q.q2_rollup_compat(star)
    grand = r.where(F.col("gid") == 31).select("total_sales").collect()
    leaves = r.where(F.col("gid") == 0).agg(F.sum("total_sales")).first()[0]
    assert len(grand) == 1 and grand[0][0] == leaves
    gs = Q.q2_grouping_sets(star)
    assert gs.where(F.col("gid") == 7).first()["total_sales"] == leaves


def test_top_k_is_ordered_and_tie_broken(star):
    rows = Q.q9_compat(star).collect()
    keys = [(-r.total_sales, r.customer_id) for r in rows]
    assert keys == sorted(keys) and len(rows) == 5
    assert all(r.unique_products == 1 for r in rows)


def test_sigma_outliers_are_outside(star):
    out = Q.q5_sigma_anomaly(star)
    assert out.count() > 0


def test_incremental_equals_full(spark, star, scratch):
    t = AggregateTable(spark, scratch("mv"), ["supplier_id", "supplier_name", "month"],
                       ["monthly_sales"])
    for i, lines in enumerate(order_slices(star)):
        t.apply_batch(Q.supplier_month(lines, star), i)
    full = Q.q8_supplier_month_mv(star)
    inc = t.read()
    assert inc.exceptAll(full).count() == 0 and full.exceptAll(inc).count() == 0


def test_replayed_batch_changes_nothing(spark, star, scratch):
    t = AggregateTable(spark, scratch("mv"), ["supplier_id", "supplier_name", "month"],
                       ["monthly_sales"])
    slices = order_slices(star)
    for i, lines in enumerate(slices):
        t.apply_batch(Q.supplier_month(lines, star), i)
    before = t.read().collect()
    t.apply_batch(Q.supplier_month(slices[1], star), 1)  # the same batch again
    t.compact()
    t.apply_batch(Q.supplier_month(slices[2], star), 2)  # replay after compaction
    assert sorted(t.read().collect()) == sorted(before)


def test_compat_fact_store_matches(star):
    f = fact.fact_load_compat(star)
    assert f.count() == 1500
    assert f.where(F.col("store_id") != 0).count() == 30


def test_dense_key_is_dense_and_ordered(spark):
    from shelfwise.operators.surrogate import dense_key
    df = spark.range(0, 5000, 1, 7).select(((F.col("id") * 7919) % 5003).alias("v"))
    k = dense_key(df, ["v"], "k", num_partitions=5).collect()
    ks = sorted(k, key=lambda r: r.k)
    assert [r.k for r in ks] == list(range(1, 5001))
    assert [r.v for r in ks] == sorted(r.v for r in ks)


def test_first_wins_picks_smallest_ordinal(spark):
    from shelfwise.operators.dedup import first_wins
    df = spark.createDataFrame(
        [(1, 3, "c"), (1, 1, "a"), (1, 2, "b"), (2, 5, "x"), (2, 4, "y")],
        "k int, ord int, v string")
    got = {r.k: r.v for r in first_wins(df, ["k"], ["ord"], ["v"]).collect()}
    assert got == {1: "a", 2: "y"}


def test_sf0001_runs(spark):
    star = build_star(spark, "/root/testdata/sf0.001")
    assert Q.q2_rollup_compat(star, "Supplier#000000002").count() > 0
    assert Q.q7_store_slice(star, "NATION_3").count() >= 0


def test_auto_compaction_keeps_the_answer(spark, star, scratch):
    t = AggregateTable(spark, scratch("mv"), ["supplier_id", "supplier_name", "month"],
                       ["monthly_sales"], compact_every=2)
    for i, lines in enumerate(order_slices(star)):
        t.apply_batch(Q.supplier_month(lines, star), i)
    path, upto = t.current()
    assert path is not None and upto == {"main": 1}
    full = Q.q8_supplier_month_mv(star)
    inc = t.read()
    assert inc.exceptAll(full).count() == 0 and full.exceptAll(inc).count() == 0


def test_refresh_all_three_tables(spark, star, scratch):
    from shelfwise.plans.aggregates import STORED, refresh_all
    root = scratch("refresh_all")
    paths = refresh_all(star, root)
    assert sorted(paths) == sorted(STORED)
    for name, (query, keys, measures) in STORED.items():
        t = AggregateTable(spark, f"{root}/{name}", keys, measures)
        assert t.read().count() == getattr(Q, query)(star).count()


@pytest.mark.parametrize("fn, keys", [
    (Q.q8_supplier_month_mv, ["supplier_id", "supplier_name", "month"]),
    (Q.q7_line, ["month", "product_id", "product_name"]),
    (Q.q10_entity_month_mv_line, ["id", "entity_type", "entity_id", "month"]),
])
def test_by_year_adds_up_to_merged_months(star, fn, keys):
    merged = fn(star)
    split = fn(star, by_year=True)
    assert "year" in split.columns and "year" not in merged.columns
    measure = [c for c in merged.columns if c not in keys][0]
    regrouped = split.groupBy(*keys).agg(F.sum(measure).cast("decimal(38,2)").alias(measure))
    assert regrouped.exceptAll(merged.select(*keys, measure)).count() == 0
    assert regrouped.count() == merged.count()


def test_mapping_uniqueness_the_plans_rely_on(star):
    """Q6, Q9 compat and Q10 compat skip a re-aggregation because each compat
    store and customer maps to one product and each product to one store."""
    for df, key in ((star.store_dim, "store_id"), (star.customer_dim, "customer_id"),
                    (star.product_store, "product_id")):
        assert df.groupBy(key).count().where(F.col("count") > 1).count() == 0
