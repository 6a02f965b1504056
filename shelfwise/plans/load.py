"""Load the warehouse from the reference's two CSV files.

Input: master data (``productID, productName, productPrice, supplierID,
supplierName, storeID, storeName``; prices like ``1299.99$``) and transactions
(``Order ID, Order Date, ProductID, CustomerID, CustomerName, Gender,
Quantity Ordered``; dates like ``4/7/19 22:30``).  Both are read with declared
all-string schemas; malformed lines, unreadable ids, prices and dates go to
``rejects`` with a reason, the rest is typed, deduplicated first-wins, keyed
and written as the warehouse that ``WarehouseStar`` queries.

Columns are found by the names in the files' header.  Each file is parsed once
and written as a typed staging table that keeps the corrupt-record text, the reject
reason and, of every row that has one, all raw fields as text.  Spark's CSV reader only parses the
columns a query needs, and then a short line may not be seen as malformed;
writing all columns once makes the detection exact, and all later steps read
columnar parquet instead of parsing text again.

Nothing is lost: a dimension takes every row whose own key can be read, whatever
is wrong with the row's other fields, and every row or line with a fault is in
``rejects`` with all its text.  Order lines whose product is unknown or has no
price are in ``fact_rejects``.

First-wins needs an order.  Master rows have their place in the file (file,
start of the read block, place in the block); one winner per product feeds both
the product and its store.  Transactions are ordered by (order date, order id,
product id, customer id, quantity, customer name, gender), unreadable dates last.

A load writes a new version folder and then switches the warehouse's pointer
to it, so a reload neither keeps rows of the load before nor shows a half-written
state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import params
from ..functions import calendar_columns, clean_price, parse_order_date, to_int, within_length
from ..operators.dedup import first_wins
from ..operators.surrogate import dense_key
from .. import schemas as S
from ..schemas import MASTER_CSV_COLUMNS, TRANSACTION_CSV_COLUMNS
from ..sources.csv import CORRUPT, header_schema, read_csv
from .warehouse import DIMENSIONS, VersionWriter, WarehouseStar

MASTER_NAMES = ("product_id", "product_name", "product_price", "supplier_id",
                "supplier_name", "store_id", "store_name")
TXN_NAMES = ("order_id", "order_date_text", "product_id", "customer_id",
             "customer_name", "gender", "quantity")
TXN_ORDER = ("order_date", "order_id", "product_id", "customer_id", "qty",
             "customer_name", "gender")


#: Where a row lies; the read block and the place in it are added to the file's name.
def row_place(file: str = "_metadata.file_path", block: str = "_metadata.file_block_start") -> F.Column:
    return F.struct(F.col(file).alias("file"), F.col(block).alias("block"),
                    F.monotonically_increasing_id().alias("place")).alias("row_ord")


def _read(spark: SparkSession, path: str, columns, names, multiline: bool = False) -> DataFrame:
    df = read_csv(spark, path, header_schema(spark, path, columns, multiline), multiline)
    return df.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(columns, names)], F.col(CORRUPT), row_place())


def _reason(*checks) -> F.Column:
    expr = None
    for cond, text in checks:
        expr = F.when(cond, F.lit(text)) if expr is None else expr.when(cond, F.lit(text))
    return expr


def _with_text(df: DataFrame, reason: F.Column) -> DataFrame:
    """``reason``, and of a row that has one ``text``: all its raw fields, as JSON, or the malformed line.

    A good row has its fields in columns of their own; writing them out once more would be most of the
    work and the bytes of a load.  The raw fields are read as ``_raw``, which is dropped."""
    text = F.coalesce(F.col(CORRUPT), F.to_json("_raw"))
    return df.withColumn("reason", reason).withColumn("text", F.when(F.col("reason").isNotNull(), text)).drop("_raw")


def typed_master_csv(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    return type_master(_read(spark, path, MASTER_CSV_COLUMNS, MASTER_NAMES, multiline))


def rename_master(raw: DataFrame) -> DataFrame:
    """Header names of the master file -> snake_case (and ``_corrupt``, ``row_ord``)."""
    return raw.select(*[F.col(f"`{c}`").alias(n)
                        for c, n in zip(MASTER_CSV_COLUMNS, MASTER_NAMES)], CORRUPT, "row_ord")


def type_master(raw: DataFrame) -> DataFrame:
    """Typed master columns and the reject reason (NULL when good)."""
    df = raw.select(
        "row_ord", to_int("product_id").alias("product_id"), "product_name",
        clean_price("product_price").alias("price"),
        to_int("supplier_id").alias("supplier_id"), "supplier_name",
        to_int("store_id", "int").alias("store_id"), "store_name", CORRUPT, F.struct(*MASTER_NAMES).alias("_raw"))
    reason = _reason(
        (F.col(CORRUPT).isNotNull(), "malformed line"),
        (F.col("product_id").isNull() | F.col("supplier_id").isNull()
         | F.col("store_id").isNull(), "non-numeric id"),
        (F.col("price").isNull(), "unreadable price"),
        (~within_length("product_name", params.NAME_MAX_LEN)
         | ~within_length("supplier_name", params.NAME_MAX_LEN)
         | ~within_length("store_name", params.NAME_MAX_LEN), "text too long"))
    return _with_text(df, reason)


def typed_transactions_csv(spark: SparkSession, path: str) -> DataFrame:
    return type_transactions(_read(spark, path, TRANSACTION_CSV_COLUMNS, TXN_NAMES))


def rename_transactions(raw: DataFrame) -> DataFrame:
    """Header names of the transaction file -> snake_case (and ``_corrupt``)."""
    return raw.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(TRANSACTION_CSV_COLUMNS, TXN_NAMES)],
                      F.col(CORRUPT), *[c for c in ("file",) if c in raw.columns])


def type_transactions(raw: DataFrame) -> DataFrame:
    """Typed transaction columns and the reject reason (NULL when good)."""
    df = raw.select(
        to_int("order_id").alias("order_id"), "order_date_text",
        parse_order_date("order_date_text").alias("order_date"),
        to_int("product_id").alias("product_id"), to_int("customer_id").alias("customer_id"),
        "customer_name", "gender", to_int("quantity", "int").alias("qty"), CORRUPT,
        *[c for c in ("row_ord", "file") if c in raw.columns], F.struct(*TXN_NAMES).alias("_raw"))
    reason = _reason(
        (F.col(CORRUPT).isNotNull(), "malformed line"),
        (F.col("order_id").isNull() | F.col("product_id").isNull()
         | F.col("customer_id").isNull() | F.col("qty").isNull(), "non-numeric id or quantity"),
        (F.coalesce(F.trim(F.col("order_date_text")), F.lit("")) == "", "empty order date"),
        (F.col("order_date").isNull(), "unparsable order date"),
        (~within_length("gender", params.GENDER_MAX_LEN), "gender longer than 10"),
        (~within_length("customer_name", params.NAME_MAX_LEN), "text too long"))
    return _with_text(df, reason)


NAMED = params.NAME_MAX_LEN
#: The text columns of a dimension's own fields and their limits.
OWN_TEXTS = {"supplier": [("supplier_name", NAMED)], "product": [("product_name", NAMED)],
             "store": [("store_name", NAMED)],
             "customer": [("customer_name", NAMED), ("gender", params.GENDER_MAX_LEN)]}


def member_rows(name: str) -> F.Column:
    """Rows that can stand for a member of dimension ``name``: only its own fields count."""
    ok = F.col(CORRUPT).isNull() & F.col(f"{name}_id").isNotNull()
    for text, limit in OWN_TEXTS[name]:
        ok = ok & within_length(text, limit)
    return ok


def winners(name: str, rows: DataFrame) -> DataFrame:
    """The first row of each member of dimension ``name``, with what it won by."""
    _, key, values, order = DIMENSIONS[name]
    if name == "customer":
        rows = rows.withColumns({"undated": F.col("order_date").isNull(), "bought": F.lit(True)})
    return first_wins(rows, [key], order, values, keep_order=True)


def line_columns(typed: DataFrame) -> DataFrame:
    """Good transactions as unkeyed order lines with their calendar parts."""
    cal = calendar_columns("order_date")
    return typed.where("reason IS NULL").select(
        "order_id", F.lit(None).cast("int").alias("line_number"), "order_date",
        *[cal[k].alias(k) for k in ("hour", "minute", "day", "year", "quarter", "month", "day_of_week")],
        "qty", "product_id", "customer_id", "customer_name", "gender")


def rejected_rows(source: str, key: str, typed: DataFrame) -> DataFrame:
    return S.conform(typed.where("reason IS NOT NULL").select(
        F.lit(source).alias("source"), F.col(key).cast("string").alias("key"), "text", "reason"), S.REJECTS)


def load_csv_warehouse(spark: SparkSession, master_path: str, transactions_path: str,
                       root: str, multiline_master: bool = False) -> dict[str, int]:
    """Read, cleanse, conform and write a new version of the warehouse under ``root``.

    ``multiline_master``: quoted fields of the master files may hold line breaks (a file
    is then read by one task).  Returns the row count of every table written (observed
    while writing)."""
    out = VersionWriter(spark, root)
    out.write("staging_master", typed_master_csv(spark, master_path, multiline_master))
    out.write("staging_transactions", typed_transactions_csv(spark, transactions_path))
    master, txn = out.read("staging_master"), out.read("staging_transactions")
    out.write("rejects", rejected_rows("master", "product_id", master).union(
        rejected_rows("transactions", "order_id", txn)))
    # a stream into this version must not bring these files again
    out.write("landed", txn.select(F.col("row_ord.file").alias("file")).distinct())
    n_txn = out.counts["staging_transactions"]

    # one winner per product: its product row and its store come from the same line;
    # compat: one product per store (the first master row of the store)
    for name in ("supplier", "product", "store"):
        out.write_dimension(name, winners(name, out.intake(name, master, member_rows(name))))

    keyed = dense_key(line_columns(txn), TXN_ORDER, "time_id", path=f"{out.folder}/_keys")
    out.write("time_dim", S.conform(keyed, S.TIME_DIM), "year", "product_id")
    out.write_dimension("customer", winners("customer", out.intake("customer", txn, member_rows("customer"))))
    out.write_fact()
    n_time = out.counts["time_dim"]
    n_bad = out.read("rejects").where("source = 'transactions'").count()
    out.write_audit([("time", n_txn, n_time, n_bad)])
    out.publish()
    return out.counts


def write_csv_inputs(star, root: str, dirty: bool = False) -> tuple[str, str]:
    """The given tables as the reference's two CSV files (with its unreadable
    dates); ``dirty`` adds unreadable prices and ids and unknown products."""
    from ..sources.csv import write_csv
    from ..sources.raw import master_csv_rows, transaction_csv_rows
    paths = f"{root}/in/master", f"{root}/in/transactions"
    # other column orders than the declared ones: columns are found by name
    master = master_csv_rows(star, dirty=dirty)
    txn = transaction_csv_rows(star, dirty=dirty)
    write_csv(master.select(*reversed(master.columns)), paths[0])
    write_csv(txn.select(*reversed(txn.columns)), paths[1])
    return paths


def loaded_csv(star, root: str, dirty: bool = False) -> WarehouseStar:
    load_csv_warehouse(star.spark, *write_csv_inputs(star, root, dirty), f"{root}/warehouse")
    return WarehouseStar(star.spark, f"{root}/warehouse")


def csv_load_fact(star, root: str) -> DataFrame:
    """The given tables through CSV files into a warehouse: the loaded fact."""
    return loaded_csv(star, root).sales_fact.drop("year")


def csv_load_rejects(star, root: str) -> DataFrame:
    """Rows of dirty CSV files that the load could not use: source, key, reason."""
    return loaded_csv(star, root, dirty=True)._t("rejects").select("source", "key", "reason")


def fact_line_rejects(star, root: str) -> DataFrame:
    """Order lines of dirty CSV files that make no fact row, with the reason."""
    return loaded_csv(star, root, dirty=True)._t("fact_rejects").select(
        "product_id", "customer_id", "qty", "reason")
