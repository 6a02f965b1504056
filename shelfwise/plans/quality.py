"""Quality checks that stand in for the reference's constraints (B9, B10,
B12) and the load counters (A8)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import params
from ..sources.star import Star


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys occurring more than once (a PRIMARY KEY check), with their count."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
            .where(F.col("n_rows") > 1))


def orphans(child: DataFrame, parent: DataFrame, child_key: str,
            parent_key: str) -> DataFrame:
    """Child rows whose key has no parent (a FOREIGN KEY check)."""
    p = parent.select(F.col(parent_key).alias(child_key))
    return child.join(p, child_key, "left_anti")


def too_long(df: DataFrame, key: str, column: str, limit: int) -> DataFrame:
    """Rows whose text exceeds a VARCHAR(limit)."""
    n = F.length(F.col(column))
    return df.where(n > limit).select(
        key, F.lit(column).alias("column_name"), F.col(column).alias("value"),
        n.alias("length"), F.lit(limit).alias("max_length"))


def check_primary_key(star: Star) -> DataFrame:
    li = star.t.lineitem.select(F.col("l_orderkey").alias("order_id"),
                                F.col("l_linenumber").alias("line_number"))
    return duplicate_keys(li, ["order_id", "line_number"])


def check_foreign_key(star: Star, root: str) -> DataFrame:
    """Loaded order lines (of dirty files) whose product is in no product row."""
    from .load import loaded_csv
    wh = loaded_csv(star, root, dirty=True)
    return orphans(wh.time_dim.select("order_id", "product_id", "customer_id", "qty"),
                   wh.product, "product_id", "product_id")


#: The six primary keys and the four foreign keys of the schema.
PRIMARY_KEYS = {"supplier_dim": "supplier_id", "product_dim": "product_id", "store_dim": "store_id",
                "customer_dim": "customer_id", "time_dim": "time_id", "sales_fact": "time_id"}
FOREIGN_KEYS = {"sales_fact.product_id": "product_dim", "sales_fact.customer_id": "customer_dim",
                "sales_fact.time_id": "time_dim", "product_dim.supplier_id": "supplier_dim"}


def constraint_violations(wh) -> DataFrame:
    """One row per key constraint of a loaded warehouse and the rows against it."""
    n = F.count(F.lit(1)).alias("violations")
    out = None
    for table, key in PRIMARY_KEYS.items():
        part = duplicate_keys(wh._t(table), [key]).agg(n).select(
            F.lit(f"primary key {table}").alias("constraint"), "violations")
        out = part if out is None else out.union(part)
    for child, parent in FOREIGN_KEYS.items():
        table, key = child.split(".")
        bad = orphans(wh._t(table).select(key).where(F.col(key).isNotNull()), wh._t(parent), key, key)
        out = out.union(bad.agg(n).select(F.lit(f"foreign key {child}").alias("constraint"), "violations"))
    return out


def check_constraints(star: Star, root: str) -> DataFrame:
    """The ten key constraints on the warehouse loaded from dirty files."""
    from .load import loaded_csv
    return constraint_violations(loaded_csv(star, root, dirty=True))


def check_lengths(star: Star) -> DataFrame:
    cust = star.t.customer.select(F.col("c_custkey").alias("customer_id"),
                                  F.col("c_mktsegment").alias("segment"))
    return too_long(cust, "customer_id", "segment", params.SEGMENT_MAX_LEN)


def load_audit_counts(star: Star, root: str) -> DataFrame:
    """The load's own audit of CSV files: rows attempted, loaded, rejected and
    skipped as repeats, per table, counted while they were written."""
    from .load import loaded_csv
    return loaded_csv(star, root)._t("load_audit")
