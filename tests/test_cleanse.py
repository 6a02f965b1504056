"""Cleansing expressions on hand-written unit cases (FIXTURES section 3)."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from shelfwise.functions import clean_price, parse_order_date, to_int, within_length


def test_order_date_formats(spark):
    cases = {
        "4/7/19 22:30": dt.datetime(2019, 4, 7, 22, 30),
        "4/19/19 8:6": dt.datetime(2019, 4, 19, 8, 6),
        "12/31/95 23:59": dt.datetime(1995, 12, 31, 23, 59),
        "1/1/01 00:00": dt.datetime(2001, 1, 1, 0, 0),
        "6/15/70 10:00": dt.datetime(1970, 6, 15, 10, 0),
        "6/15/69 10:00": dt.datetime(2069, 6, 15, 10, 0),
        "13/45/19 10:00": None,
        "04/31/19 08:46": None,
        "04/19/2019 08:46": None,
        "04/19/19 08:46 x": None,
        "": None,
        "Order Date": None,
    }
    df = spark.createDataFrame([(k,) for k in cases], "s string")
    got = {r.s: r.t for r in df.select("s", parse_order_date("s").alias("t")).collect()}
    assert got == cases


def test_two_digit_years_both_centuries(spark):
    df = spark.createDataFrame([("3/1/99 00:00",), ("3/1/00 00:00",)], "s string")
    years = sorted(r.y for r in df.select(F.year(parse_order_date("s")).alias("y")).collect())
    assert years == [1999, 2000]


def test_clean_price(spark):
    cases = [("1299.99$", Decimal("1299.99")), ("9.5$", Decimal("9.50")),
             ("1299.995$", Decimal("1300.00")), ("$12", Decimal("12.00")),
             ("99999999999.99$", None), ("abc$", None), (None, None)]
    df = spark.createDataFrame([(c,) for c, _ in cases], "s string")
    got = [r.p for r in df.select(clean_price("s").alias("p")).collect()]
    assert got == [v for _, v in cases]


def test_to_int_and_length(spark):
    df = spark.createDataFrame([(" 42 ", "MACHINERY"), ("4x", "AUTOMOBILE"), (None, None)],
                               "i string, s string")
    rows = df.select(to_int("i").alias("i"), within_length("s", 9).alias("ok")).collect()
    assert [(r.i, r.ok) for r in rows] == [(42, True), (None, False), (None, True)]


def test_order_date_ignores_session_zone(spark):
    """A daylight-saving gap in the session zone must not move the time."""
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        df = spark.createDataFrame([("3/10/19 2:30",), ("11/3/19 1:30",)], "s string")
        got = [r.t for r in df.select(parse_order_date("s").alias("t")).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert got == [dt.datetime(2019, 3, 10, 2, 30), dt.datetime(2019, 11, 3, 1, 30)]
