"""OLAP building blocks: revenue at product grain, drill-down, rollup and
grouping sets, quarter pivot, top-k and the sigma test.

Revenue is ``SUM(qty * price)``.  Price is constant per product, so the sum
is computed as ``price * SUM(qty)`` per product and group: order lines are
aggregated *before* they meet the product dimension.  The join then sees one
row per (product, group) instead of one per line, and a product holding a
third of all lines is collapsed map-side before any shuffle.  Decimal
arithmetic makes both forms exactly equal.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import MONEY


def money(c: Column) -> Column:
    return c.cast(MONEY)


def qty_by_product(lines: DataFrame, group_cols: Sequence[str] = ()) -> DataFrame:
    """SUM(qty) per (product_id, *group_cols): the pre-aggregation step."""
    return (lines.groupBy("product_id", *group_cols)
            .agg(F.sum("qty").alias("sum_qty")))


def revenue_by_product(lines: DataFrame, product: DataFrame,
                       group_cols: Sequence[str] = (),
                       product_cols: Sequence[str] = ()) -> DataFrame:
    """Pre-aggregated lines joined to products, with ``revenue`` and ``sum_qty``."""
    pre = qty_by_product(lines, group_cols)
    prod = product.select("product_id", "price",
                          *[c for c in product_cols if c not in ("product_id", "price")])
    return (pre.join(prod, "product_id")
            .withColumn("revenue", F.col("sum_qty") * F.col("price")))


def drill_down(df: DataFrame, keys: Sequence[str], levels: Sequence[str],
               depth: int, measure: str = "revenue", alias: str = "total_sales") -> DataFrame:
    """Totals of ``measure`` by ``keys`` and the first ``depth`` hierarchy levels."""
    by = list(keys) + list(levels[:depth])
    return df.groupBy(*by).agg(money(F.sum(measure)).alias(alias))


def rollup_sum(df: DataFrame, cols: Sequence[str], measure: str = "revenue",
               alias: str = "total_sales", gid: str | None = "gid") -> DataFrame:
    aggs = [money(F.sum(measure)).alias(alias)]
    if gid:
        aggs.append(F.grouping_id().cast("int").alias(gid))
    return df.rollup(*cols).agg(*aggs)


def grouping_sets_sum(df: DataFrame, sets: Sequence[Sequence[str]],
                      cols: Sequence[str], measure: str = "revenue",
                      alias: str = "total_sales", gid: str | None = "gid") -> DataFrame:
    aggs = [money(F.sum(measure)).alias(alias)]
    if gid:
        aggs.append(F.grouping_id().cast("int").alias(gid))
    return df.groupingSets([list(s) for s in sets], *cols).agg(*aggs)


def pivot_sum(df: DataFrame, keys: Sequence[str], pivot_col: str,
              values: Sequence, measure: str, names: Sequence[str],
              total: str | None = None) -> DataFrame:
    """Values of ``pivot_col`` as columns: conditional sums (0, never NULL,
    for a missing cell), plus an optional row total, in one aggregate.
    Whole-number measures come out as BIGINT, decimal ones as money."""
    is_decimal = isinstance(df.schema[measure].dataType, T.DecimalType)
    out_type = MONEY if is_decimal else T.LongType()
    aggs = [F.sum(F.when(F.col(pivot_col) == v, F.col(measure)).otherwise(F.lit(0)))
            .cast(out_type).alias(n) for v, n in zip(values, names)]
    if total:
        aggs.append(F.sum(measure).cast(out_type).alias(total))
    return df.groupBy(*keys).agg(*aggs)


def top_k(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    """ORDER BY ... LIMIT k, planned as a per-partition top-k and a merge
    (TakeOrderedAndProject); callers pass a unique tie-break as last key."""
    return df.orderBy(*order).limit(k)


def sigma_outliers(df: DataFrame, value: str, k: float) -> DataFrame:
    """Rows whose ``value`` lies more than ``k`` sample standard deviations
    from the mean of all rows.

    Mean and deviation are scalar subqueries: each is a global aggregate
    with a partial step (count, sum, sum of squares per task), joined to
    nothing.  ``OVER ()`` would move every row into one partition.
    """
    v = F.col(value).cast("double")
    stats = df.select(v.alias("_v"))
    mean = stats.select(F.avg("_v")).scalar()
    sd = stats.select(F.stddev_samp("_v")).scalar()
    return df.where(F.abs(v - mean) > F.lit(k) * sd)
