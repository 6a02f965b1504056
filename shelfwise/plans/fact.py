"""Sales fact loads (A5, B4, C4, C5, C8) and the read-back (A6, C9).

Compat grain follows the reference: one row per customer of the customer
dimension; time id = the first order line of the customer's product, store
id = the first store carrying that product, else 0 (the "unknown" member);
total sale = quantity of that line x price of the product.

Line grain is what an analyst means: one row per order line with its own time
id and the store of its product.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import params
from ..operators.joins import first_match, lookup_first, read_back
from ..schemas import SALE
from ..sources.star import Star

FACT_KEYS = ["product_id", "customer_id", "time_id", "store_id"]


def lookup_time_first(star: Star) -> DataFrame:
    """lookup_time_first: first time id (lowest) of each customer's product."""
    outer = star.first_products
    return lookup_first(outer, star.time_dim.select("product_id", "time_id"),
                        "product_id", "time_id").select(
        "customer_id", "product_id", "time_id")


def lookup_store_first(star: Star) -> DataFrame:
    """lookup_store_first: first store (lowest id) carrying the product, else 0."""
    outer = star.customer_dim.select("customer_id", "product_id")
    return lookup_first(outer, star.store_dim.select("product_id", "store_id"),
                        "product_id", "store_id", default=params.UNKNOWN_STORE).select(
        "customer_id", "product_id", "store_id")


REASON_NO_PRODUCT = "unknown product"
REASON_NO_PRICE = "product without a price"
REASON_NO_TIME = "no order line for the product"
REASON_RANGE = "total sale out of range"


def _total_sale(qty, price):
    """quantity x price; NULL, not an error, beyond DECIMAL(18,2)."""
    return (qty * price).try_cast(SALE)


def compat_lookup(star: Star) -> DataFrame:
    """The compat fact's lookups prepared as one table, one row per product:
    price, first order line (time id and its quantity) and first store."""
    first_time = first_match(star.time_dim.select("product_id", "time_id", "qty"),
                             "product_id", "time_id", ["qty"])
    first_store = first_match(star.store_dim.select("product_id", "store_id"),
                              "product_id", "store_id")
    price = star.product.select("product_id", "price", F.lit(True).alias("known"))
    return (price.join(first_time, "product_id", "full")
            .join(first_store, "product_id", "left"))


def fact_rows_compat(star: Star, outer: DataFrame | None = None,
                     lookup: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(fact, rejects) at compat grain for the ``outer`` customer rows.

    One join against the prepared lookup: both of its sides come straight from
    a shuffle, so AQE can split a hot product."""
    if outer is None:
        outer = star.first_products
    df = outer.join(lookup if lookup is not None else compat_lookup(star), "product_id", "left")
    df = df.select(*outer.columns, "time_id", "qty", "price", "known",
                   F.coalesce("store_id", F.lit(params.UNKNOWN_STORE)).alias("store_id"),
                   _total_sale(F.col("qty"), F.col("price")).alias("total_sale"))
    # a missing time or product breaks a foreign key: reject, do not write 0
    reason = (F.when(F.col("known").isNull(), REASON_NO_PRODUCT)
              .when(F.col("price").isNull(), REASON_NO_PRICE)
              .when(F.col("time_id").isNull(), REASON_NO_TIME)
              .when(F.col("total_sale").isNull(), REASON_RANGE))
    df = df.withColumn("reason", reason)
    return (df.where("reason IS NULL").select(*FACT_KEYS, "total_sale"),
            df.where("reason IS NOT NULL").select("customer_id", "product_id", "reason"))


def fact_load_compat(star: Star) -> DataFrame:
    return fact_rows_compat(star)[0]


def product_lookup(star: Star) -> DataFrame:
    """Price and store of every product, one row each (line grain)."""
    stored = getattr(star, "priced_products", None)  # a warehouse stores them together
    if stored is not None:
        return stored
    return (star.product.select("product_id", "price", F.lit(True).alias("known"))
            .join(star.product_store.select("product_id", "store_id"), "product_id", "left"))


def judged_lines(star: Star, lines: DataFrame | None = None,
                 lookup: DataFrame | None = None) -> DataFrame:
    """Every keyed order line with store, total sale and ``reason`` (NULL: a fact
    row).  No line is lost: a line whose product is unknown or has no price
    keeps its reason.  Lines are joined once, to the prepared product lookup."""
    if lines is None:
        lines = star.time_dim
    df = lines.join(lookup if lookup is not None else product_lookup(star), "product_id", "left")
    sale = _total_sale(F.col("qty"), F.col("price"))
    reason = (F.when(F.col("known").isNull(), REASON_NO_PRODUCT)
              .when(F.col("price").isNull(), REASON_NO_PRICE)
              .when(sale.isNull(), REASON_RANGE))
    return df.select(
        "product_id", "customer_id", "time_id",
        F.coalesce("store_id", F.lit(params.UNKNOWN_STORE)).alias("store_id"),
        sale.alias("total_sale"), "year", "qty", reason.alias("reason"))


FACT_LINE = [*FACT_KEYS, "total_sale", "year"]
LINE_REJECT = ["time_id", "product_id", "customer_id", "qty", "year", "reason"]


def fact_rows_line(star: Star, lines: DataFrame | None = None) -> DataFrame:
    """Line-grain fact rows for keyed order lines (``time_dim`` columns)."""
    return judged_lines(star, lines).where("reason IS NULL").select(*FACT_LINE)


def fact_rejects_line(star: Star, lines: DataFrame | None = None) -> DataFrame:
    """Order lines that make no fact row, with the reason."""
    return judged_lines(star, lines).where("reason IS NOT NULL").select(*LINE_REJECT)


def fact_load_line(star: Star) -> DataFrame:
    return fact_rows_line(star).drop("year")


def write_fact(fact: DataFrame, path: str, partition_by: str | None = None) -> None:
    """Write fact rows; with ``partition_by`` the year partitions of a rerun are
    replaced (dynamic partition overwrite), so a retried load is idempotent."""
    if not partition_by:
        fact.sortWithinPartitions("product_id").write.mode("overwrite").parquet(path)
        return
    # partition column first, so the writer keeps this order instead of
    # re-sorting on the partition column alone
    (fact.sortWithinPartitions(partition_by, "product_id")
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(partition_by).parquet(path))


def fact_readback_semi(star: Star, path: str) -> DataFrame:
    """Write the compat fact, read it back, keep rows whose 4-part key is in
    the batch just written (the reference's SELECT after each INSERT).  The batch is computed
    once and kept beside the fact."""
    fact = fact_load_compat(star)
    fact.write.mode("overwrite").parquet(f"{path}_batch")
    batch = star.spark.read.schema(fact.schema).parquet(f"{path}_batch")
    write_fact(batch, path)
    stored = star.spark.read.parquet(path)
    return read_back(stored, batch, FACT_KEYS)
