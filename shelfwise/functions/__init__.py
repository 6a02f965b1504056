"""Column expressions: cleansing and calendar derivations (all JVM-side)."""

from .cleanse import (calendar_columns, clean_price, parse_order_date,
                      to_int, within_length)

__all__ = ["calendar_columns", "clean_price", "parse_order_date", "to_int",
           "within_length"]
