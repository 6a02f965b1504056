"""Staging of stream fixtures: rows written as files in ordinal ranges.

Rows are numbered densely in their total order, split into ``n`` ranges and
each range is written by its own job, one after another, so a file source
sees the ranges arrive in order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.surrogate import dense_key

ROW_GROUP = 4 << 20  # bytes: several tasks can share a landed file, so a batch of few files keeps all cores busy


def number_rows(df: DataFrame, order_cols: Sequence[str], key: str = "row_id", staged: bool = False) -> DataFrame:
    """Dense ordinal 1..n (checkpointed, see ``operators.surrogate``)."""
    return dense_key(df, order_cols, key, staged=staged)


def range_bounds(df: DataFrame, key: str, n: int | None,
                 rows_per_range: int | None = None) -> list[tuple[int, int]]:
    """Contiguous (lo, hi] ranges of a dense key 1..total: ``n`` equal ranges,
    or ranges of ``rows_per_range`` rows (the last one shorter).  Reads one
    aggregate row."""
    total = df.agg(F.max(key)).first()[0] or 0
    if rows_per_range:
        cuts = list(range(0, total, rows_per_range)) + [total]
        return [(cuts[i], cuts[i + 1]) for i in range(len(cuts) - 1)]
    cuts = [round(total * i / n) for i in range(n + 1)]
    return [(cuts[i], cuts[i + 1]) for i in range(n)]


def write_range(df: DataFrame, key: str, lo: int, hi: int, path: str) -> None:
    (df.where((F.col(key) > lo) & (F.col(key) <= hi))
     .write.mode("append").option("parquet.block.size", ROW_GROUP).parquet(path))
