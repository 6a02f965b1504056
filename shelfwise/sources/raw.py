"""Raw string inputs made from the test tables (FIXTURES.md section 3).

The reference loads two CSV files whose every field is a string: master data
(one row per product, with supplier and store) and transactions (one row per
order line).  These views rebuild both from the typed tables, deterministically,
and carry the explicit ordinal that stands in for the file's row order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import params
from .star import LINE_ORDER, Star

# fixed values: text layout of an order date in the raw transactions
RAW_DATE_FORMAT = "M/d/yy HH:mm"
HEADER_TEXT = "Order Date"


def raw_master(star: Star, conflicts: bool = True, dirty: bool = False) -> DataFrame:
    """Master data rows: product, price text with '$', supplier, store.

    Suppliers of every 7th part carry the suffix ' Ltd', so one supplier id
    has two names and first-wins matters.  Ordinal: the product id (row order
    of the master file).  One chain of two joins: part -> supplier -> nation.
    """
    n_sup = star.t.supplier.select(F.count(F.lit(1))).scalar()
    part = star.t.part.select(
        F.col("p_partkey").alias("product_id"), F.col("p_name").alias("product_name"),
        F.col("p_retailprice").alias("p_price"),
        (F.col("p_partkey") % n_sup).alias("supplier_id"))
    sup = star.t.supplier.select(F.col("s_suppkey").alias("supplier_id"),
                                 F.col("s_name").alias("supplier_name"),
                                 F.col("s_nationkey").alias("nation_id"))
    nat = star.t.nation.select(F.col("n_nationkey").alias("nation_id"),
                               F.col("n_name").alias("store_name"))
    base = part.join(sup, "supplier_id").join(nat, "nation_id")
    name = F.when(F.col("product_id") % params.CONFLICT_PART_EVERY == 0,
                  F.concat(F.col("supplier_name"), F.lit(" Ltd"))
                  ).otherwise(F.col("supplier_name"))
    if not conflicts:
        name = F.col("supplier_name")
    price = F.concat(F.col("p_price").cast("string"), F.lit("$"))
    if dirty:
        price = F.when(F.col("product_id") % params.BAD_PRICE_EVERY == 0,
                       F.lit(params.BAD_PRICE_TEXT)).otherwise(price)
    return base.select(
        F.col("product_id").alias("row_ord"),
        F.col("product_id").cast("string").alias("product_id"),
        F.col("product_name"),
        price.alias("product_price"),
        F.col("supplier_id").cast("string").alias("supplier_id"),
        name.alias("supplier_name"),
        (F.col("nation_id") + 1).cast("string").alias("store_id"),
        F.col("store_name"))


def order_date_text(order_date: str = "order_date", order_id: str = "order_id",
                    bad_dates: bool = True):
    """Date text of a raw transaction; every 97th order key carries the header
    text and every 89th (otherwise) an empty string: unparsable rows."""
    text = F.date_format(order_date, RAW_DATE_FORMAT)
    if not bad_dates:
        return text
    return (F.when(F.col(order_id) % params.RAW_DATE_HEADER_EVERY == 0, F.lit(HEADER_TEXT))
            .when(F.col(order_id) % params.RAW_DATE_EMPTY_EVERY == 0, F.lit(""))
            .otherwise(text))


def raw_transactions(star: Star, bad_dates: bool = True, dirty: bool = False) -> DataFrame:
    """Transaction rows as strings, plus the total-order columns as ordinal.

    ``dirty``: some customer ids are unreadable and some products are in no
    master row."""
    lines = star.lines_base()
    cust = star.t.customer.select(F.col("c_custkey").alias("customer_id"),
                                  F.col("c_name").alias("customer_name"),
                                  F.col("c_mktsegment").alias("gender"))
    df = lines.join(cust, "customer_id")
    product, customer = F.col("product_id"), F.col("customer_id").cast("string")
    if dirty:
        order = F.col("order_id")
        product = F.when(order % params.UNKNOWN_PRODUCT_EVERY == 0,
                         product + params.UNKNOWN_PRODUCT_SHIFT).otherwise(product)
        customer = F.when(order % params.BAD_ID_EVERY == 0,
                          F.concat(F.lit(params.BAD_ID_TEXT), customer)).otherwise(customer)
    return df.select(
        *[F.col(c).alias(f"ord_{c}") for c in LINE_ORDER],
        F.col("order_id").cast("string").alias("order_id_text"),
        order_date_text(bad_dates=bad_dates).alias("order_date_text"),
        product.cast("string").alias("product_id_text"),
        customer.alias("customer_id_text"),
        "customer_name", "gender",
        F.col("qty").cast("string").alias("quantity_text"))


RAW_ORDER = tuple(f"ord_{c}" for c in LINE_ORDER)


def master_csv_rows(star: Star, conflicts: bool = True, dirty: bool = False) -> DataFrame:
    """Master data as the reference's file holds it (header names, '$' prices),
    in the order of its rows."""
    from ..schemas import MASTER_CSV_COLUMNS
    m = raw_master(star, conflicts, dirty).orderBy("row_ord")
    return m.select(*[F.col(c).alias(h) for c, h in zip(
        ("product_id", "product_name", "product_price", "supplier_id", "supplier_name",
         "store_id", "store_name"), MASTER_CSV_COLUMNS)])


def transaction_csv_rows(star: Star, bad_dates: bool = True, dirty: bool = False,
                         more: dict[str, Column] | None = None) -> DataFrame:
    """Transactions as the reference's file holds them (header names, date text); ``more``: further columns,
    of ``raw_transactions``."""
    from ..schemas import TRANSACTION_CSV_COLUMNS
    t = raw_transactions(star, bad_dates, dirty)
    return t.select(*[F.col(c).alias(h) for c, h in zip(
        ("order_id_text", "order_date_text", "product_id_text", "customer_id_text",
         "customer_name", "gender", "quantity_text"), TRANSACTION_CSV_COLUMNS)],
        *[c.alias(n) for n, c in (more or {}).items()])
