"""Ingest: typed, cleansed rows from raw strings, with rejects kept.

Replaces the reference's insert triggers (price cleansing, date parsing,
calendar parts) and its "ignore the failed batch" handling: rows that do not
parse are split off with a reason instead of failing or vanishing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import calendar_columns, clean_price, parse_order_date, to_int
from ..operators.surrogate import dense_key
from ..sources.raw import RAW_ORDER, raw_master, raw_transactions
from ..sources.star import Star

REASON_EMPTY = "empty order date"
REASON_BAD = "unparsable order date"
REASON_BAD_ID = "non-numeric id or quantity"


def typed_master(star: Star) -> DataFrame:
    """Master rows with typed ids and the cleansed price (B1, B11)."""
    m = raw_master(star)
    return m.select(
        "row_ord",
        to_int("product_id").alias("product_id"), "product_name",
        clean_price("product_price").alias("price"),
        to_int("supplier_id").alias("supplier_id"), "supplier_name",
        to_int("store_id", "int").alias("store_id"), "store_name")


def clean_price_rows(star: Star) -> DataFrame:
    """clean_price: price text '900.10$' -> DECIMAL(10,2), one row per product."""
    return typed_master(star).select("product_id", "price")


def parsed_transactions(star: Star) -> DataFrame:
    """Raw transactions with typed ids and the parsed order date (B2, B11)."""
    raw = raw_transactions(star)
    return raw.select(
        *RAW_ORDER,
        to_int("order_id_text").alias("order_id"),
        F.col("ord_line_number").alias("line_number"),
        "order_date_text",
        parse_order_date("order_date_text").alias("order_ts"),
        to_int("product_id_text").alias("product_id"),
        to_int("customer_id_text").alias("customer_id"),
        "customer_name", "gender",
        to_int("quantity_text", "int").alias("qty"))


def parse_order_date_rows(star: Star) -> DataFrame:
    """parse_order_date: every line with its date text and parsed timestamp."""
    return parsed_transactions(star).select(
        "order_id", "line_number", "product_id", "order_date_text", "order_ts")


def reject_reason(parsed_date: str = "order_ts"):
    """Why a parsed transaction is rejected; NULL for a good row."""
    return (F.when(F.col("order_id").isNull() | F.col("product_id").isNull()
                   | F.col("customer_id").isNull() | F.col("qty").isNull(),
                   F.lit(REASON_BAD_ID))
            .when(F.coalesce(F.trim(F.col("order_date_text")), F.lit("")) == "",
                  F.lit(REASON_EMPTY))
            .when(F.col(parsed_date).isNull(), F.lit(REASON_BAD)))


def transactions_with_reason(star: Star) -> DataFrame:
    """Parsed transactions with ``reason`` (NULL for a good row)."""
    return parsed_transactions(star).withColumn("reason", reject_reason())


def split_transactions(star: Star) -> tuple[DataFrame, DataFrame]:
    """(good, rejects): one column holds the reason, two filters split on it."""
    df = transactions_with_reason(star)
    good = df.where(F.col("reason").isNull()).drop("reason")
    bad = df.where(F.col("reason").isNotNull())
    return good, bad


def reject_bad_dates(star: Star) -> DataFrame:
    """reject_bad_dates: the rejected lines with their reason."""
    _, bad = split_transactions(star)
    return bad.select("order_id", "line_number", "product_id", "order_date_text", "reason")


def calendar_parts(events: DataFrame) -> DataFrame:
    """calendar_parts: hour .. quarter and weekday of ``events.ts``."""
    cal = calendar_columns("ts")
    return events.select(F.col("event_id"), *[c.alias(n) for n, c in cal.items()])


def dim_time(star: Star) -> DataFrame:
    """dim_time: the order-line table from raw strings (B7): good rows only,
    calendar parts, and ``time_id`` dense 1..n in the total order (B8)."""
    cal = calendar_columns("order_date")
    rows = transactions_with_reason(star).select(
        *RAW_ORDER, "order_id", F.col("order_ts").alias("order_date"), "qty", "product_id", "customer_id", "reason")
    keyed = dense_key(rows, RAW_ORDER, "time_id", staged=True, where="reason IS NULL")
    return keyed.select("time_id", "order_id", "order_date",
                        *[cal[k].alias(k) for k in ("hour", "minute", "day", "year", "quarter", "month")],
                        "qty", "product_id", "customer_id")


# fixed values: suffix that puts a comma and quotes into every supplier name
CSV_NAME_SUFFIX = ', "Intl" Co.'


def csv_suppliers(star: Star) -> DataFrame:
    """Supplier rows whose names need quoting: a comma and embedded quotes."""
    return star.supplier.select(
        "supplier_id", F.concat(F.col("supplier_name"), F.lit(CSV_NAME_SUFFIX))
        .alias("supplier_name"))


def csv_roundtrip_scan(star: Star, path: str) -> DataFrame:
    """Write the suppliers as CSV, read them back with the declared schema;
    well-formed rows only (malformed ones stay in ``_corrupt``)."""
    from ..schemas import SUPPLIER_CSV
    from ..sources.csv import good_rows, read_csv, write_csv
    write_csv(csv_suppliers(star), path)
    return good_rows(read_csv(star.spark, path, SUPPLIER_CSV))
