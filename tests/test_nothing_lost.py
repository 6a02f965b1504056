"""Dirty, late and repeated input: no row is lost, doubled or mixed up."""

import os

import pytest
from pyspark.sql import functions as F

from shelfwise.plans import fact as FT
from shelfwise.plans import queries as Q
from shelfwise.plans.aggregates import AggregateTable, order_slices
from shelfwise.plans.load import load_csv_warehouse, loaded_csv
from shelfwise.plans.warehouse import WarehouseStar
from shelfwise.session import local_path
from shelfwise.sources.star import Star
from shelfwise.streaming import jobs as S

MASTER_HEAD = "productID,productName,productPrice,supplierID,supplierName,storeID,storeName"
TXN_HEAD = "Order ID,Order Date,ProductID,CustomerID,CustomerName,Gender,Quantity Ordered"


@pytest.fixture
def load(spark, scratch):
    def run(master, transactions, root=None, heads=(MASTER_HEAD, TXN_HEAD)):
        root = root or scratch("small")
        paths = []
        for name, head, rows in (("master", heads[0], master), ("txn", heads[1], transactions)):
            folder = f"{local_path(root)}/in-{len(os.listdir(local_path(root))) if os.path.isdir(local_path(root)) else 0}-{name}"
            os.makedirs(folder)
            with open(f"{folder}/part-0.csv", "w") as fh:
                fh.write("\n".join([head, *rows]) + "\n")
            paths.append(folder)
        counts = load_csv_warehouse(spark, *paths, f"{root}/wh")
        return WarehouseStar(spark, f"{root}/wh"), counts, root
    return run


GOOD_MASTER = ["1,Pen,2.50$,10,Acme,100,North", "2,Cup,3.00$,20,Bolt,200,South"]


def test_lines_are_fact_or_reject(load):
    wh, counts, _ = load(
        GOOD_MASTER + ["3,Hat,oops,30,Cloth,300,West"],
        ["1,4/7/97 10:00,1,5,Ann,F,2", "2,4/7/97 10:05,3,5,Ann,F,1", "3,4/7/97 10:06,99,6,Bob,M,1",
         "4,bad,1,7,Cid,M,1", "5,4/8/97 09:00,2,x7,Dan,M,1", "6,4/8/97 09:00,1,8,Eve,F,2000000000"])
    assert counts["time_dim"] == counts["sales_fact"] + counts["fact_rejects"] == 4
    assert counts["staging_transactions"] == counts["time_dim"] + 2
    assert {(r.product_id, r.reason) for r in wh._t("fact_rejects").collect()} == {
        (3, FT.REASON_NO_PRICE), (99, FT.REASON_NO_PRODUCT)}
    big = wh.sales_fact.where("customer_id = 8").first()  # beyond DECIMAL(10,2), still a sale
    assert str(big.total_sale) == "5000000000.00"
    # the dimensions take what they can read, whatever else is wrong with the row
    assert {r.supplier_id for r in wh.supplier.collect()} == {10, 20, 30}
    assert {r.store_id for r in wh.store_dim.collect()} == {100, 200, 300}
    assert {r.customer_id for r in wh.customer.collect()} == {5, 6, 7, 8}
    texts = [r.text for r in wh._t("rejects").collect()]
    assert any("x7" in t for t in texts) and any("oops" in t for t in texts)
    audit = {r.table_name: r for r in wh._t("load_audit").collect()}
    assert (audit["customer"].attempted, audit["customer"].loaded, audit["customer"].rejected,
            audit["customer"].repeated) == (6, 4, 1, 1)
    assert audit["time"].rejected == 2 and all(r.repeated >= 0 for r in audit.values())


def test_columns_are_found_by_name(load):
    heads = ("storeName,storeID,productID,productName,supplierID,productPrice,supplierName",
             "CustomerID,ProductID,Order ID,Order Date,Quantity Ordered,Gender,CustomerName")
    wh, _, _ = load(["North,100,1,Pen,10,2.50$,Acme"], ["5,1,77,4/7/97 10:00,2,F,Ann"], heads=heads)
    row = wh.sales_fact.first()
    assert (row.product_id, row.customer_id, row.store_id, str(row.total_sale)) == (1, 5, 100, "5.00")
    with pytest.raises(ValueError, match="header"):
        load(["x"], ["y"], heads=("a,b,c,d,e,f,g", TXN_HEAD))


def test_one_master_row_wins_a_product(load):
    wh, _, _ = load(["7,Zebra,1.00$,10,Acme,100,North", "7,Apple,9.00$,20,Bolt,200,South"],
                    ["1,4/7/97 10:00,7,5,Ann,F,1"])
    p, s = wh.product.first(), wh.product_store.first()
    assert (p.product_name, p.supplier_id, str(p.price), s.store_id) == ("Zebra", 10, "1.00", 100)


def test_a_reload_keeps_nothing_of_the_load_before(load):
    wh, _, root = load(GOOD_MASTER, ["1,4/7/97 10:00,1,5,Ann,F,2", "2,4/7/98 10:00,2,6,Bob,M,1"])
    assert wh.lines.count() == 2
    again, counts, _ = load(GOOD_MASTER, ["3,4/7/99 10:00,1,5,Ann,F,2"], root=root)
    assert counts["time_dim"] == 1
    assert [r.order_id for r in again.lines.collect()] == [3] and again.sales_fact.count() == 1
    assert wh.lines.count() == 2  # a reader of the version before is not disturbed


def test_dirty_tables_add_up(spark, star, scratch):
    wh = loaded_csv(star, scratch("dirty"), dirty=True)
    lines, fact, bad = wh.lines.count(), wh.sales_fact.count(), wh._t("fact_rejects").count()
    rejected = wh._t("rejects").where("source = 'transactions'").count()
    assert lines == fact + bad and bad > 0
    assert lines + rejected == wh._t("staging_transactions").count() == 60000


def test_stream_lines_are_fact_or_reject(spark, star, scratch):
    class Gappy(Star):
        @property
        def product(self):
            return super().product.where("product_id % 10 != 0")

        def refreshed(self):
            return self
    gappy, path = Gappy(star.t), scratch("gappy") + "/fact"
    lines = star.time_dim.select("time_id", "product_id", "customer_id", "qty", "year")
    S.enrich_sink(gappy, path)(lines, 0)
    fact, bad = spark.read.parquet(path), spark.read.parquet(f"{path}_rejects")
    assert fact.count() + bad.count() == lines.count() and bad.count() > 0
    assert {r.reason for r in bad.select("reason").distinct().collect()} == {FT.REASON_NO_PRODUCT}


def test_refresh_between_increments_does_not_double(spark, star, scratch):
    keys = ["supplier_id", "supplier_name", "month"]
    t = AggregateTable(spark, scratch("mv"), keys, ["monthly_sales"], compact_every=2)
    full = Q.q8_supplier_month_mv(star)
    for i, lines in enumerate(order_slices(star)):
        t.apply_batch(Q.supplier_month(lines, star), i)
    t.refresh_full(full)
    t.compact()
    assert t.read().exceptAll(full).count() == 0 and full.exceptAll(t.read()).count() == 0


def test_two_streams_share_a_target(spark, scratch):
    root = scratch("two")
    for name, order in (("a", 1), ("b", 9)):
        landing = f"{local_path(root)}/landing-{name}"
        os.makedirs(landing)
        with open(f"{landing}/part-0.csv", "w") as fh:
            fh.write(f"{TXN_HEAD}\n{order},4/7/97 10:00,1,5,Ann,F,2\n")
        S.ingest_csv_stream(spark, landing, root, stream=name)
    rows = spark.read.parquet(f"{root}/lines").orderBy("order_id").collect()
    assert [(r.order_id, r.time_id, r.batch_id) for r in rows] == [(1, 1, 0), (9, 2, 0)]


def test_fractional_quantity_is_not_cut(spark, star, scratch):
    root = scratch("fraction")
    src = star.t.sf_dir
    for t in ("orders", "part", "supplier", "nation", "customer", "region", "events"):
        spark.read.parquet(f"{src}/{t}.parquet").limit(50).write.parquet(f"{root}/{t}.parquet")
    spark.read.parquet(f"{src}/lineitem.parquet").limit(10).withColumn(
        "l_quantity", F.lit(2.5)).write.parquet(f"{root}/lineitem.parquet")
    from shelfwise.sources.star import build_star
    assert build_star(spark, root).lines_base().where("qty IS NOT NULL").count() == 0


def test_hot_product_join_is_split(spark, star, scratch):
    """With broadcasts off and half of all lines on one product, AQE splits the
    one join of the line fact and that of the compat fact."""
    small = {"spark.sql.autoBroadcastJoinThreshold": "-1",
             "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
             "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k",
             "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
             "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8k"}
    before = {k: spark.conf.get(k, None) for k in small}
    root = scratch("hot")
    star.time_dim.withColumn("product_id", F.when(F.col("time_id") % 2 == 0, F.lit(7))
                             .otherwise(F.col("product_id"))).repartition(16).write.parquet(f"{root}/lines")
    FT.product_lookup(star).write.parquet(f"{root}/lookup")
    try:
        for k, v in small.items():
            spark.conf.set(k, v)
        lines, lookup = (spark.read.parquet(f"{root}/{n}") for n in ("lines", "lookup"))
        judged = FT.judged_lines(star, lines, lookup)
        judged.write.format("noop").mode("overwrite").save()
        df = judged.where("reason IS NULL")
        df.collect()
        assert "skew=true" in df._jdf.queryExecution().executedPlan().toString()
        outer = lines.select("customer_id", "product_id")
        FT.compat_lookup(star).write.parquet(f"{root}/compat")
        fact, _ = FT.fact_rows_compat(star, outer, spark.read.parquet(f"{root}/compat"))
        fact.collect()
        assert "skew=true" in fact._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_loaded_and_streamed_warehouse_adds_up(spark, star, scratch):
    from shelfwise.streaming.warehouse import loaded_and_streamed, warehouse_sink
    wh = loaded_and_streamed(star, scratch("both"))
    lines = wh.lines.count()
    assert lines == wh.sales_fact.count() + wh._t("fact_rejects").count() == 58785
    assert lines + wh._t("rejects").count() == 60000
    ids = wh.lines.agg(F.min("time_id"), F.max("time_id"), F.countDistinct("time_id")).first()
    assert tuple(ids) == (1, lines, lines)
    assert wh.customer.count() == wh.customer.select("customer_id").distinct().count() == 1500
    # a batch that is run again changes nothing
    raw = spark.read.parquet(f"{wh.base}/time_dim").where("stream = 'second' AND batch_id = 1")
    before = sorted(raw.select("time_id", "order_id").collect())
    from shelfwise.schemas import TRANSACTION_CSV_COLUMNS
    from shelfwise.sources.csv import CORRUPT, header_schema, read_csv
    folder = wh.root.rsplit("/", 1)[0] + "/in/second"
    files = sorted(read_csv(spark, folder, header_schema(spark, folder, TRANSACTION_CSV_COLUMNS)).inputFiles())
    assert len(files) == 2 and before
    for f in files:
        again = read_csv(spark, f, header_schema(spark, folder, TRANSACTION_CSV_COLUMNS))
        if again.where(F.col("`Order ID`") == str(before[0].order_id)).count():
            warehouse_sink(spark, wh.root, "second")(again, 1)
            break
    raw = spark.read.parquet(f"{wh.base}/time_dim").where("stream = 'second' AND batch_id = 1")
    assert sorted(raw.select("time_id", "order_id").collect()) == before
    assert WarehouseStar(spark, wh.root).lines.count() == lines
