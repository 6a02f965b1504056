"""Dimensions with first-wins deduplication (B6a-d), conflicts (B15) and the
incremental "not yet seen" append (C10 / K6)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import params
from ..operators.dedup import conflicting_attributes, first_wins, new_keys_only
from ..operators.surrogate import dense_key
from ..sources.raw import RAW_ORDER
from ..sources.star import LINE_ORDER, Star
from .ingest import parsed_transactions, typed_master


def dim_supplier(star: Star) -> DataFrame:
    """Supplier dimension: the first master row of each supplier id wins."""
    return first_wins(typed_master(star).where(F.col("supplier_id").isNotNull()),
                      ["supplier_id"], ["row_ord"], ["supplier_name"])


def dim_product(star: Star) -> DataFrame:
    """Product dimension with the cleansed price."""
    return first_wins(typed_master(star).where(F.col("product_id").isNotNull()),
                      ["product_id"], ["row_ord"],
                      ["product_name", "supplier_id", "price"])


def dim_store(star: Star) -> DataFrame:
    """Store dimension: the first master row of a store gives its product."""
    return first_wins(typed_master(star).where(F.col("store_id").isNotNull()),
                      ["store_id"], ["row_ord"], ["store_name", "product_id"])


def dim_customer(star: Star) -> DataFrame:
    """Customer dimension: the first transaction of a customer (in the total
    order) gives name, gender and product."""
    rows = parsed_transactions(star)
    return first_wins(rows.where(F.col("customer_id").isNotNull()), ["customer_id"],
                      RAW_ORDER, ["customer_name", "gender", "product_id"])


def dim_conflicts(star: Star) -> DataFrame:
    """Supplier ids that arrive with more than one name in the master data."""
    return conflicting_attributes(typed_master(star), "supplier_id", "supplier_name")


def dim_incremental_anti(star: Star) -> DataFrame:
    """Customers first seen now: the orders before a day made the stored
    dimension; of the later ones, in-batch first-wins, then ``left_anti``."""
    day = F.lit(params.STORED_BEFORE + " 00:00:00").cast("timestamp_ntz")
    stored = star.with_order_filter(F.col("order_date") < day).customer_dim
    batch = star.with_order_filter(F.col("order_date") >= day).customer_dim
    return new_keys_only(batch, stored, ["customer_id"])


def surrogate_key(star: Star) -> DataFrame:
    """Dense time ids over the total order of all order lines (B8)."""
    keyed = dense_key(star.lines_base().select(*LINE_ORDER), LINE_ORDER, "time_id")
    return keyed.select("time_id", *LINE_ORDER)
