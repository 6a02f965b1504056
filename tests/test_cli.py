"""The command line end to end on CSV files written from the given tables."""

import os

from shelfwise.__main__ import main
from shelfwise.plans.warehouse import WarehouseStar
from shelfwise.session import local_path
from shelfwise.sources.csv import write_csv
from shelfwise.sources.raw import master_csv_rows, transaction_csv_rows


def test_load_query_refresh(spark, star, scratch, capsys):
    root = scratch("cli")
    write_csv(master_csv_rows(star), f"{root}/m")
    write_csv(transaction_csv_rows(star), f"{root}/t")
    assert main(["load", "--master", f"{root}/m", "--transactions", f"{root}/t",
                 "--warehouse", f"{root}/wh"]) == 0
    assert main(["query", "q4_quarter_pivot", "--warehouse", f"{root}/wh",
                 "--out", f"{root}/q4"]) == 0
    assert spark.read.parquet(f"{root}/q4").count() > 0
    assert main(["refresh", "q8_supplier_month_mv", "--warehouse", f"{root}/wh",
                 "--table", f"{root}/mv"]) == 0
    assert main(["refresh-all", "--warehouse", f"{root}/wh", "--tables", f"{root}/tables"]) == 0
    # files that land later, of transactions and of master data
    head = "Order ID,Order Date,ProductID,CustomerID,CustomerName,Gender,Quantity Ordered"
    for name, text in (("new", f"{head}\n999999999,4/7/97 10:00,1,5,Ann,F,2\n"),
                       ("more", "productID,productName,productPrice,supplierID,supplierName,storeID,storeName\n"
                                '99999999,"Pen\nblue",2.50$,10,Acme,1,North\n')):
        os.makedirs(f"{local_path(root)}/{name}")
        with open(f"{local_path(root)}/{name}/1.csv", "w") as f:
            f.write(text)
    assert main(["stream", "--landing", f"{root}/new", "--warehouse", f"{root}/wh", "--files-per-batch", "1"]) == 0
    assert main(["stream-master", "--landing", f"{root}/more", "--warehouse", f"{root}/wh", "--multiline"]) == 0
    assert WarehouseStar(spark, f"{root}/wh").product.where("product_id = 99999999").count() == 1
    out = capsys.readouterr().out
    assert '"sales_fact": {"attempted": 1, "loaded": 1, "rejected": 0, "repeated": 0}' in out
    assert "supplier_performance" in out
    assert '"time_dim": 58785' in out and "/mv/v=" in out


def test_query_options():
    import pytest
    from shelfwise.__main__ import QUERY_NAMES, main
    assert "q9_from_pairs" not in QUERY_NAMES
    with pytest.raises(SystemExit):
        main(["query", "q4_quarter_pivot", "--warehouse", "x", "--supplier", "S"])
