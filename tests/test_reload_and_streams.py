"""Loads and streams into one warehouse, in any order, twice, and at the same time."""

import os
import threading

import pytest
from pyspark.sql import functions as F

from shelfwise.plans.load import load_csv_warehouse
from shelfwise.plans.warehouse import WarehouseStar, current_version, dimension, read_batches
from shelfwise.session import local_path
from shelfwise.streaming import jobs as S
from shelfwise.streaming import warehouse as SW
from tests.test_nothing_lost import GOOD_MASTER, MASTER_HEAD, TXN_HEAD


class Shop:
    """A warehouse, the files of its load and the folders where more files land."""

    def __init__(self, spark, root):
        self.spark, self.dir, self.wh, self.clock = spark, local_path(root), f"{root}/wh", 1_700_000_000

    def land(self, folder, name, rows, head=TXN_HEAD):
        os.makedirs(f"{self.dir}/{folder}", exist_ok=True)
        path = f"{self.dir}/{folder}/{name}.csv"
        with open(path, "w") as f:
            f.write("\n".join([head, *rows]) + "\n")
        self.clock += 10  # a stream takes files in order of their times
        os.utime(path, (self.clock, self.clock))

    def load(self, transactions=("1,4/7/97 10:00,1,5,Ann,F,2",), master=GOOD_MASTER, folder="loaded"):
        if not os.path.isdir(f"{self.dir}/master"):
            self.land("master", "part-0", master, MASTER_HEAD)
        if not os.path.isdir(f"{self.dir}/{folder}"):
            self.land(folder, "part-0", transactions)
        load_csv_warehouse(self.spark, f"{self.dir}/master", f"{self.dir}/{folder}", self.wh)

    def stream(self, folder, **kw):
        SW.stream_into_warehouse(self.spark, f"{self.dir}/{folder}", self.wh, stream=folder, **kw)

    def master(self, folder, **kw):
        SW.stream_master_into_warehouse(self.spark, f"{self.dir}/{folder}", self.wh, stream=folder, **kw)

    @property
    def star(self):
        return WarehouseStar(self.spark, self.wh)

    def orders(self):
        return sorted(r.order_id for r in self.star.lines.collect())

    def sold(self):
        """(order, sale) of every fact row."""
        star = self.star
        rows = star.sales_fact.join(star.lines.select("time_id", "order_id"), "time_id").collect()
        return sorted((r.order_id, str(r.total_sale)) for r in rows)


@pytest.fixture
def shop(spark, scratch):
    return Shop(spark, scratch("shop"))


def test_a_reload_reads_the_landed_files_again(shop):
    shop.load()
    shop.land("a", "1", ["2,4/8/97 10:00,2,6,Bob,M,1"])
    shop.stream("a")
    assert shop.orders() == [1, 2]
    shop.stream("a")  # nothing new
    assert shop.orders() == [1, 2]
    old = current_version(shop.spark, shop.wh)
    shop.load()
    assert shop.orders() == [1]
    shop.land("a", "2", ["3,4/9/97 10:00,1,5,Ann,F,1"])
    shop.stream("a")
    assert shop.orders() == [1, 2, 3] and shop.sold() == [(1, "5.00"), (2, "3.00"), (3, "2.50")]
    ids = sorted(r.time_id for r in shop.star.lines.collect())
    assert ids == [1, 2, 3]
    # the version before is as it was
    assert WarehouseStar(shop.spark, shop.wh, base=old).lines.count() == 2


def test_a_reload_between_batches_and_during_one(shop):
    shop.load()
    for k in range(3):
        shop.land("a", str(k), [f"{10 + k},4/8/97 1{k}:00,2,6,Bob,M,1"])
    runs = []

    def overtaken(spark, root, stream, base):
        sink = SW.transaction_sink(spark, root, stream, base)

        def run(batch, batch_id):
            runs.append((base, batch_id))
            if len(runs) == 2:  # a load is faster than this batch
                shop.load()
            sink(batch, batch_id)
        return run

    SW._drain(shop.spark, f"{shop.dir}/a", shop.wh, 1, "a", overtaken)
    bases = [b for b, _ in runs]
    assert len(set(bases)) == 2 and bases == sorted(bases, key=bases.index) and len(runs) == 6
    assert shop.orders() == [1, 10, 11, 12]
    # each version holds the batches that began in it, whole
    for base in set(bases):
        star = WarehouseStar(shop.spark, shop.wh, base=base)
        assert star.lines.count() == star.sales_fact.count() == 4


def test_a_file_of_the_load_is_not_streamed_again(shop):
    shop.land("a", "1", ["2,4/8/97 10:00,2,6,Bob,M,1"])
    shop.load(folder="a")  # loads what has landed so far
    shop.land("a", "2", ["3,4/9/97 10:00,1,5,Ann,F,1"])
    shop.stream("a", files_per_batch=1)
    assert shop.orders() == [2, 3]
    # nor by another stream over the same folder
    SW.stream_into_warehouse(shop.spark, f"{shop.dir}/a", shop.wh, stream="b")
    assert shop.orders() == [2, 3]


def _ids(spark, path, stream):
    rows = spark.read.parquet(path).where(F.col("stream") == stream).collect()
    return sorted((r.batch_id, r.order_id, r.time_id) for r in rows)


def _sink_rows(spark, orders):
    from shelfwise.schemas import csv_strings, TRANSACTION_CSV_COLUMNS
    rows = [(str(o), "4/7/97 10:00", "1", "5", "Ann", "F", "2", None) for o in orders]
    return spark.createDataFrame(rows, csv_strings(TRANSACTION_CSV_COLUMNS))


def test_interleaved_streams_keep_their_ids(spark, scratch):
    root = scratch("mixed")
    a, b = S.csv_ingest_sink(root, "a"), S.csv_ingest_sink(root, "b")
    a(_sink_rows(spark, [1, 2, 3]), 0)
    b(_sink_rows(spark, [4, 5]), 0)
    first = _ids(spark, f"{root}/lines", "a"), _ids(spark, f"{root}/lines", "b")
    assert [t for *_, t in first[0]] == [1, 2, 3] and [t for *_, t in first[1]] == [4, 5]
    a(_sink_rows(spark, [1, 2, 3]), 0)   # replayed after the other stream's batch
    a(_sink_rows(spark, [6]), 1)
    b(_sink_rows(spark, [4, 5]), 0)
    assert _ids(spark, f"{root}/lines", "b") == first[1]
    assert _ids(spark, f"{root}/lines", "a") == [*first[0], (1, 6, 6)]


def test_streams_at_the_same_time_share_no_id(shop):
    shop.load()
    names = ("a", "b")
    for n, name in enumerate(names):
        for k in range(4):
            shop.land(name, str(k), [f"{100 * (n + 1) + 10 * k + j},4/8/97 10:0{j},2,{6 + j},Bob,M,1" for j in range(3)])
    errors = []

    def run(name):
        try:
            shop.stream(name, files_per_batch=1)
        except Exception as e:  # noqa: BLE001
            errors.append(e)

    threads = [threading.Thread(target=run, args=(n,)) for n in names]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert not errors, errors[0]
    ids = sorted(r.time_id for r in shop.star.lines.collect())
    assert ids == list(range(1, 26))
    assert shop.star.sales_fact.count() == 25
    assert sorted(r.customer_id for r in shop.star.customer.collect()) == [5, 6, 7, 8]


def test_lines_wait_for_their_product_and_move_once(shop):
    shop.load(["1,4/7/97 10:00,1,5,Ann,F,2", "2,4/7/98 10:00,9,5,Ann,F,2"])
    shop.land("a", "1", ["3,4/8/97 10:00,8,6,Bob,M,4", "4,4/8/97 10:01,1,6,Bob,M,1"])
    shop.stream("a")
    assert [o for o, _ in shop.sold()] == [1, 4] and shop.star._t("fact_rejects").count() == 2
    shop.land("m", "1", ["9,Hat,4.00$,30,Cloth,300,West"], MASTER_HEAD)
    shop.master("m")
    assert shop.sold() == [(1, "5.00"), (2, "8.00"), (4, "2.50")]
    waiting = shop.star._t("fact_rejects").collect()
    assert [r.product_id for r in waiting] == [8]
    shop.land("m", "2", ["8,Bag,1.25$,30,Cloth,300,West", "9,Hat again,5.00$,30,Cloth,300,West"], MASTER_HEAD)
    shop.master("m")
    assert shop.sold() == [(1, "5.00"), (2, "8.00"), (3, "5.00"), (4, "2.50")]
    assert shop.star._t("fact_rejects").count() == 0
    fact = {r.time_id: (r.store_id, r.year) for r in shop.star.sales_fact.collect()}
    assert sorted(fact.values()) == [(100, 1997), (100, 1997), (300, 1997), (300, 1998)]
    # the batch of lines run again finds the product itself: still one fact
    sink = SW.transaction_sink(shop.spark, shop.wh, "a")
    from shelfwise.schemas import TRANSACTION_CSV_COLUMNS
    from shelfwise.sources.csv import header_schema, read_csv
    again = read_csv(shop.spark, f"{shop.dir}/a", header_schema(shop.spark, f"{shop.dir}/a", TRANSACTION_CSV_COLUMNS))
    sink(again, 0)
    assert shop.sold() == [(1, "5.00"), (2, "8.00"), (3, "5.00"), (4, "2.50")]
    # and so does a batch of products
    base = current_version(shop.spark, shop.wh)
    late = read_batches(shop.spark, base, "fact_late")
    assert sorted(r.batch_id for r in late.collect()) == [0, 1]


def test_a_product_that_comes_while_lines_are_judged(shop, monkeypatch):
    shop.load()
    shop.land("a", "1", ["3,4/8/97 10:00,8,6,Bob,M,4"])
    shop.land("m", "1", ["8,Bag,1.25$,30,Cloth,300,West"], MASTER_HEAD)
    plain = SW.judged_lines
    calls = []

    def slow(star, lines):
        judged = plain(star, lines)
        calls.append(1)
        if len(calls) == 1:
            judged.persist().count()    # judged without the product
            shop.master("m")
        return judged

    monkeypatch.setattr(SW, "judged_lines", slow)
    shop.stream("a")
    assert shop.sold() == [(1, "5.00"), (3, "5.00")] and shop.star._t("fact_rejects").count() == 0


MASTER_FILES = {
    "a": ["1,Pen,2.50$,10,Acme,100,North", "7,Zebra,1.00$,10,Acme Ltd,200,South"],
    "b": ["7,Apple,9.00$,20,Bolt,200,South Side", "2,Cup,oops,20,Bolt Ltd,100,Far North"],
    "c": ["2,Cup,3.00$,20,Bolt & Co,300,West", "x,Bad,3.00$,20,Nope,300,West", "5,Jar,1.00$,11,Lid,200,S"],
}


@pytest.mark.parametrize("order", ["abc", "cba", "bca", "cab"])
def test_dimensions_do_not_depend_on_arrival(shop, spark, scratch, order):
    def members(star):
        return [sorted(tuple(r) for r in star._t(t).collect())
                for t in ("supplier_dim", "product_dim", "product_store", "store_dim")]

    whole = Shop(spark, scratch("whole"))
    for name in "abc":
        whole.land("m", name, MASTER_FILES[name], MASTER_HEAD)
    whole.land("t", "1", ["1,4/7/97 10:00,1,5,Ann,F,2"])
    load_csv_warehouse(spark, f"{whole.dir}/m", f"{whole.dir}/t", whole.wh)
    # one file by the load, the others by a stream, all in one folder
    shop.land("m", order[0], MASTER_FILES[order[0]], MASTER_HEAD)
    shop.land("t", "1", ["1,4/7/97 10:00,1,5,Ann,F,2"])
    load_csv_warehouse(spark, f"{shop.dir}/m", f"{shop.dir}/t", shop.wh)
    for name in order[1:]:
        shop.land("m", name, MASTER_FILES[name], MASTER_HEAD)
        shop.master("m")
    assert members(shop.star) == members(whole.star)
    assert shop.star.product.count() == 4 and {r.text for r in shop.star._t("rejects").collect()} == {
        r.text for r in whole.star._t("rejects").collect()}


def test_the_first_line_of_a_customer_wins_whenever_it_comes(shop):
    shop.load(["1,4/7/97 10:00,1,5,Ann,F,2"])
    shop.land("a", "1", ["2,4/9/97 10:00,2,6,Robert,M,1", "3,4/6/97 10:00,2,5,Anna,F,1"])
    shop.stream("a")
    shop.land("a", "2", ["4,4/1/97 10:00,1,6,Bob,M,1"])  # later, of an earlier day
    shop.stream("a")
    rows = {r.customer_id: (r.customer_name, r.product_id) for r in shop.star.customer_dim.collect()}
    assert rows == {5: ("Anna", 2), 6: ("Bob", 1)}


def test_the_audit_counts_streamed_rows(shop):
    shop.load(["1,4/7/97 10:00,1,5,Ann,F,2", "9,oops,1,5,Ann,F,2"])
    shop.land("a", "1", ["2,4/8/97 10:00,2,6,Bob,M,1", "3,bad,2,6,Bob,M,1", "4,4/8/97 10:01,9,x,Cid,M,1"])
    shop.land("a", "2", ["5,4/8/97 10:02,9,6,Bob,M,1", "6,4/8/97 10:03,1,7,Eve,F,1"])
    shop.stream("a", files_per_batch=1)
    shop.land("m", "1", ["9,Hat,4.00$,30,Cloth,300,West", "z,No,4.00$,30,Cloth,300,West"], MASTER_HEAD)
    shop.master("m")
    star, audit = shop.star, SW.audit_totals(shop.spark, shop.wh)
    for row in audit.values():
        assert row["attempted"] == row["loaded"] + row["rejected"] + row["repeated"]
    assert audit["time"]["loaded"] == star.lines.count() == 4
    assert audit["time"]["rejected"] == star._t("rejects").where("source != 'm'").count() == 3
    assert audit["customer"] == {"attempted": 7, "loaded": 3, "rejected": 1, "repeated": 3}
    assert audit["sales_fact"]["loaded"] == 2 and audit["late_line"]["loaded"] == 1
    assert audit["product"]["loaded"] == star.product.count() == 3
    assert SW.audit_totals(shop.spark, shop.wh, "m")["product"] == {
        "attempted": 2, "loaded": 1, "rejected": 1, "repeated": 0}


def test_folds_bound_the_files_of_a_dimension(shop, monkeypatch):
    from shelfwise.plans import warehouse as W
    monkeypatch.setattr(W, "FOLD_EVERY", 2)
    shop.load()
    for k in range(7):
        shop.land("a", f"{k}", [f"{10 + k},4/8/97 1{k}:00,2,{20 + k},Bob{k},M,1"])
    shop.stream("a", files_per_batch=1)
    table = dimension(shop.spark, current_version(shop.spark, shop.wh), "customer")
    assert len(table.written()) <= 4 and len(table.journal.numbers()) == 2
    assert sorted(r.customer_id for r in shop.star.customer.collect()) == [5, *range(20, 27)]


def test_master_fields_may_hold_line_breaks(shop):
    rows = ['1,"Pen\nblue",2.50$,10,"Acme, ""the"" shop",100,North', "2,Cup,3.00$,20,Bolt,200,South"]
    shop.land("master", "part-0", rows, MASTER_HEAD)
    shop.land("t", "1", ["1,4/7/97 10:00,1,5,Ann,F,2"])
    load_csv_warehouse(shop.spark, f"{shop.dir}/master", f"{shop.dir}/t", shop.wh, multiline_master=True)
    assert {r.product_name for r in shop.star.product.collect()} == {"Pen\nblue", "Cup"}
    assert shop.star._t("rejects").count() == 0 and shop.sold() == [(1, "5.00")]
    shop.land("m", "2", ['3,"Jar\nred",1.00$,10,Acme,100,North'], MASTER_HEAD)
    shop.master("m", multiline=True)
    assert "Jar\nred" in {r.product_name for r in shop.star.product.collect()}
