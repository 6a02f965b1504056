"""Cleansing expressions that replace the reference's insert triggers.

Every function returns a ``Column`` built from ``pyspark.sql.functions`` so it
runs inside whole-stage codegen; nothing here is a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import params
from ..schemas import PRICE


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_price(raw) -> Column:
    """'1299.99$' -> DECIMAL(10,2); strips every '$', NULL when unreadable.

    ``try_cast`` rounds half-up to two places and gives NULL on overflow.
    """
    return F.replace(F.trim(_c(raw)), F.lit("$"), F.lit("")).try_cast(PRICE)


def to_int(raw, dtype: str = "bigint") -> Column:
    """String id or quantity -> integer; NULL when the text is not a number."""
    return F.trim(_c(raw)).try_cast(dtype)


def parse_order_date(raw) -> Column:
    """Order-date text ``M/d/yy H:m`` -> TIMESTAMP_NTZ, NULL when it does not
    parse.

    The layout is checked by one regular expression (one- or two-digit month,
    day, hour and minute, a two-digit year, no trailing text), the fields are
    cut out at their separators (no second regular expression: a field is wanted once a line and
    a split would be made anew for each of them) and the value is built with ``try_make_timestamp_ntz``, which
    gives NULL for impossible dates (month 13, April 31, hour 24).  No time
    zone is involved, so a session zone with daylight-saving gaps cannot move
    a wall-clock time.  Years 70-99 are 1970-1999, 00-69 are 2000-2069, as in
    the reference.
    """
    text = F.trim(_c(raw))
    last = F.substring_index(text, "/", -1)
    # try_cast gives NULL, never an ANSI error, whatever the text
    m, d, yy, hh, mi = (c.try_cast("int") for c in (
        F.substring_index(text, "/", 1), F.substring_index(F.substring_index(text, "/", 2), "/", -1),
        F.substring_index(last, " ", 1), F.substring_index(F.substring_index(text, " ", -1), ":", 1),
        F.substring_index(text, ":", -1)))
    year = yy + F.when(yy >= params.TWO_DIGIT_YEAR_PIVOT, F.lit(1900)).otherwise(F.lit(2000))
    ts = F.try_make_timestamp_ntz(year, m, d, hh, mi, F.lit(0))
    return F.when(text.rlike(params.ORDER_DATE_LAYOUT), ts)


def calendar_columns(ts) -> dict[str, Column]:
    """Hour, minute, day, month, year, quarter and weekday (1 = Sunday)."""
    t = _c(ts)
    return {
        "hour": F.hour(t),
        "minute": F.minute(t),
        "day": F.dayofmonth(t),
        "month": F.month(t),
        "year": F.year(t),
        "quarter": F.quarter(t),
        "day_of_week": F.dayofweek(t),
    }


def within_length(c, n: int) -> Column:
    """True when the text fits a VARCHAR(n); NULL text counts as fitting."""
    return F.coalesce(F.length(_c(c)) <= n, F.lit(True))
