"""Constraints of streamed lines, checked batch by batch."""

import json

import pytest
from pyspark.sql import functions as F

from shelfwise.plans.warehouse import WarehouseStar, current_version, read_batches
from shelfwise.streaming import constraints as C
from shelfwise.streaming import warehouse as SW
from tests.helpers import plan_text
from tests.test_reload_and_streams import Shop


@pytest.fixture
def shop(spark, scratch):
    return Shop(spark, scratch("checked"))


def violations(shop):
    rows = read_batches(shop.spark, current_version(shop.spark, shop.wh), "violations").collect()
    return [(s, b, c, json.loads(k)) for s, b, c, k in sorted((r.stream, r.batch_id, r.constraint, r.key) for r in rows)]


def test_repeated_lines_and_orphans_are_reported(shop):
    shop.load(["1,4/7/97 10:00,1,5,Ann,F,2", "2,4/7/98 10:00,2,6,Bob,M,1"])
    shop.land("a", "1", ["3,4/8/97 10:00,1,5,Ann,F,4", "4,4/8/97 10:00,9,7,Cid,M,4",
                         "2,4/7/98 10:00,2,6,Bob,M,1",                # a line of the load
                         "2,4/7/98 10:00,2,6,Bob,M,3"])               # another quantity
    shop.land("a", "2", ["5,4/9/97 10:00,1,5,Ann,F,1", "5,4/9/97 10:00,1,5,Ann,F,1",   # twice in a batch
                         "3,4/8/97 10:00,1,5,Ann,F,4"])               # a line of the batch before
    shop.stream("a", files_per_batch=1, checked=True)
    found = [(b, c, k.get("order_id"), k.get("product_id")) for _, b, c, k in violations(shop)]
    assert found == [(0, C.NO_PRODUCT, None, 9), (0, C.REPEATED, 2, 2), (1, C.REPEATED, 3, 1), (1, C.REPEATED, 5, 1)]
    # a batch that is run again reports the same, also after later ones
    before = violations(shop)
    base = current_version(shop.spark, shop.wh)
    lines = read_batches(shop.spark, base, "time_dim").where("stream = 'a' AND batch_id = 0")
    C.check_batch(WarehouseStar(shop.spark, shop.wh), lines.drop("stream", "batch_id"), 0, "a")
    assert violations(shop) == before


def test_the_filter_misses_no_line(shop, monkeypatch):
    """With a filter of very few blocks nearly all is suspected, with many nearly nothing; the result is the same."""
    shop.load([f"{k},4/7/9{k % 4 + 5} 10:00,1,5,Ann,F,{k % 3 + 1}" for k in range(1, 200)])
    star = shop.star
    lines = read_batches(shop.spark, star.base, "time_dim").where("stream = 'load'").drop("stream", "batch_id")
    new = lines.withColumn("order_id", F.col("order_id") + 1000)
    mixed = lines.where("order_id % 10 = 0").union(new)
    for blocks, most in ((2, 300), (1 << 20, 25)):
        monkeypatch.setattr(C, "line_filter", lambda spark, base, b=blocks: C.LineFilter(spark, f"{base}/filter{b}"))
        C.seed_filter(star, blocks)
        suspects = C.maybe_seen(shop.spark, star.base, mixed, 0, "s", blocks)
        assert 19 <= suspects.count() <= most
        got = C.same_lines(shop.spark, star.base, suspects, 0, "s")
        assert sorted(r.order_id for r in got.collect()) == list(range(10, 200, 10))


def test_the_exact_test_reads_years_and_orders_in_question(shop):
    shop.load([f"{k},4/7/9{k % 4 + 5} 10:00,1,5,Ann,F,1" for k in range(1, 50)])
    star = shop.star
    lines = read_batches(shop.spark, star.base, "time_dim").drop("stream", "batch_id")
    suspects = lines.where("order_id IN (8, 12)").select("year", *C.LINE_KEY)
    df = C.same_lines(shop.spark, star.base, suspects, 0, "s")
    plan = plan_text(df)
    assert "GreaterThanOrEqual(order_id,8)" in plan and "LessThanOrEqual(order_id,12)" in plan
    assert "PartitionFilters: [" in plan and "1995" in plan.split("PartitionFilters", 2)[1] and df.count() == 2
