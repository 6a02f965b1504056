"""The reference's two CSV files -> warehouse -> the same answers.

Files are written from the given tables in the reference's format (header
names with spaces, '$' prices, 'M/d/yy HH:mm' dates), plus a file of broken
lines that must land in ``rejects``."""

import pytest
from pyspark.sql import functions as F

from shelfwise.plans import queries as Q
from shelfwise.plans.load import load_csv_warehouse
from shelfwise.plans.warehouse import WarehouseStar
from shelfwise.session import local_path
from shelfwise.sources.csv import write_csv
from shelfwise.sources.raw import master_csv_rows, transaction_csv_rows
from tests.helpers import digest

BROKEN_TXN = (
    'Order ID,Order Date,ProductID,CustomerID,CustomerName,Gender,Quantity Ordered\n'
    '1,13/45/97 10:00,5,5,"Customer#5",HOUSEHOLD,3\n'
    'x1,4/7/97 10:00,5,5,"Customer#5",HOUSEHOLD,3\n'
    '2,4/7/97 10:00,5,5,"Customer#5",HOUSEHOLD\n'
    '3,,5,5,"Customer#5",HOUSEHOLD,3\n'
    '4,4/7/97 10:00,5,5,"Customer#5",HOUSEHOLD PLUS MORE,3\n')
BROKEN_MASTER = (
    'productID,productName,productPrice,supplierID,supplierName,storeID,storeName\n'
    '9999999,"Gadget, large",12.5x$,1,"Acme, Inc.",1,Shop\n')


@pytest.fixture(scope="module")
def csv_wh(spark, star):
    from shelfwise.session import new_scratch
    root = new_scratch(spark, "csv_wh")
    mpath, tpath = f"{root}/in/master", f"{root}/in/transactions"
    write_csv(master_csv_rows(star, conflicts=False), mpath)
    write_csv(transaction_csv_rows(star, bad_dates=False), tpath)
    with open(local_path(tpath) + "/broken.csv", "w") as fh:
        fh.write(BROKEN_TXN)
    with open(local_path(mpath) + "/zz-broken.csv", "w") as fh:
        fh.write(BROKEN_MASTER)
    counts = load_csv_warehouse(spark, mpath, tpath, f"{root}/wh")
    return WarehouseStar(spark, f"{root}/wh"), counts


def test_counts_and_rejects(spark, csv_wh):
    wh, counts = csv_wh
    assert counts["time_dim"] == 60000
    assert counts["product_dim"] == 2001  # a product whose price is unreadable is a product
    assert counts["supplier_dim"] == 100 and counts["store_dim"] == 25
    assert counts["customer_dim"] == 1500
    assert counts["rejects"] == 6
    assert counts["staging_transactions"] == 60005 and counts["staging_master"] == 2001
    reasons = sorted(r.reason for r in wh._t("rejects").collect())
    assert reasons == sorted(["unparsable order date", "non-numeric id or quantity",
                              "malformed line", "empty order date",
                              "gender longer than 10", "unreadable price"])


@pytest.mark.parametrize("name", ["q1_supplier_drilldown", "q2_rollup_compat",
                                  "q2_grouping_sets", "q3_weekend_top5", "q4_quarter_pivot",
                                  "q5_sigma_anomaly", "q6_store_product_mv", "q6_line",
                                  "q7_store_slice", "q7_line", "q8_supplier_month_mv",
                                  "q9_line", "q10_entity_month_mv_line"])
def test_same_answers_as_the_tables(star, csv_wh, name):
    wh, _ = csv_wh
    fn = getattr(Q, name)
    a, b = fn(star), fn(wh)
    ra, rb = [tuple(r) for r in a.collect()], [tuple(r) for r in b.collect()]
    assert len(ra) == len(rb)
    assert digest(a.columns, ra) == digest(b.columns, rb)


def test_fact_total(csv_wh):
    from decimal import Decimal
    wh, _ = csv_wh
    assert wh.sales_fact.agg(F.sum("total_sale")).first()[0] == Decimal("1447849638.00")


def test_loaded_mappings_are_unique(csv_wh):
    wh, _ = csv_wh
    for df, key in ((wh.store_dim, "store_id"), (wh.customer_dim, "customer_id"),
                    (wh.product_store, "product_id")):
        assert df.groupBy(key).count().where(F.col("count") > 1).count() == 0
