"""The ten OLAP questions of the reference, over a ``Star``.

Where the reference's grain is odd (one product per store, the first product
of a customer) there are two forms: ``*_compat`` keeps the reference's
definition, ``*_line`` answers at order-line grain.

Every query aggregates order lines by product (and the calendar keys it
needs) before joining a dimension; see ``operators.olap``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import params
from ..operators.olap import (drill_down, grouping_sets_sum, money, pivot_sum,
                              qty_by_product, revenue_by_product, rollup_sum,
                              sigma_outliers, top_k)
from ..sources.star import Star

CALENDAR = ("year", "quarter", "month")


def q1_supplier_drilldown(star: Star, depth: int = 3) -> DataFrame:
    """Q1: supplier sales by year -> quarter -> month (``depth`` levels)."""
    rev = revenue_by_product(star.lines, star.product, CALENDAR, ["supplier_id"])
    df = rev.join(star.supplier, "supplier_id")
    out = drill_down(df, ["supplier_id", "supplier_name"], CALENDAR, depth)
    return out.orderBy("supplier_id", *CALENDAR[:depth])


def lines_of(lines: DataFrame, products: DataFrame) -> DataFrame:
    """Order lines of the chosen products only, reduced before any aggregate."""
    return lines.join(products.select("product_id"), "product_id", "left_semi")


def _q2_input(star: Star, supplier_name: str, year: int) -> DataFrame:
    sup = star.supplier.where(F.col("supplier_name") == supplier_name)
    prod = star.product.join(sup, "supplier_id")
    return revenue_by_product(lines_of(star.lines_in_year(year), prod), prod, ["month"],
                              ["product_name", "supplier_id", "supplier_name"])


def q2_rollup_compat(star: Star, supplier_name: str = params.SUPPLIER_NAME,
                     year: int = params.YEAR) -> DataFrame:
    """Q2: ROLLUP(product_id, product_name, month, supplier_id, supplier_name),
    diced on one supplier and one year (6 grouping sets, as the reference)."""
    df = _q2_input(star, supplier_name, year)
    cols = ["product_id", "product_name", "month", "supplier_id", "supplier_name"]
    return rollup_sum(df, cols).orderBy(
        F.col("product_id").asc_nulls_first(), F.col("month").asc_nulls_first(), "gid")


def q2_grouping_sets(star: Star, supplier_name: str = params.SUPPLIER_NAME,
                     year: int = params.YEAR) -> DataFrame:
    """Q2 as meant: (product, month), (product), () for one supplier and year."""
    df = _q2_input(star, supplier_name, year)
    cols = ["product_id", "product_name", "month"]
    sets = [cols, ["product_id", "product_name"], []]
    return grouping_sets_sum(df, sets, cols).orderBy(
        F.col("product_id").asc_nulls_first(), F.col("month").asc_nulls_first())


def q3_weekend_top5(star: Star, k: int = params.TOP_K) -> DataFrame:
    """Q3: the k products with most units sold on Saturdays and Sundays."""
    weekend = star.lines.where(F.col("day_of_week").isin(1, 7))
    qty = qty_by_product(weekend).select(
        "product_id", F.col("sum_qty").cast("bigint").alias("total_quantity"))
    best = top_k(qty, [F.col("total_quantity").desc(), F.col("product_id")], k)
    named = best.join(star.product.select("product_id", "product_name"), "product_id")
    return named.select("product_id", "product_name", "total_quantity").orderBy(
        F.col("total_quantity").desc(), "product_id")


def q4_quarter_pivot(star: Star, year: int = params.YEAR,
                     measure: str = "qty") -> DataFrame:
    """Q4: quarters of one year as columns plus the year total, per product.

    The lines are pivoted straight away (one aggregate by product with a
    partial step, conditional sums per quarter), then product names (and
    prices) are joined to the result: one shuffle for the whole pivot.  The
    reference sums quantities although it asks for sales; ``measure`` may be
    ``"qty"`` (default, as the reference) or ``"revenue"`` (price x units,
    exact because the price is constant per product).
    """
    names = ["q1", "q2", "q3", "q4"]
    piv = pivot_sum(star.lines_in_year(year), ["product_id"], "quarter", [1, 2, 3, 4],
                    "qty", names, total="yearly_total")
    prod = star.product.select("product_id", "product_name", "price")
    df = piv.join(prod, "product_id")
    cols = names + ["yearly_total"]
    if measure == "revenue":
        out = [money(F.col(c) * F.col("price")).alias(c) for c in cols]
    else:
        out = [F.col(c) for c in cols]
    return df.select("product_id", "product_name", *out).orderBy("product_id")


def product_totals(lines: DataFrame, star: Star) -> DataFrame:
    """Total sales of every product that ``lines`` hold."""
    rev = revenue_by_product(lines, star.product, (), ["product_name"])
    return rev.select("product_id", "product_name", money(F.col("revenue")).alias("total_sales"))


def q5_sigma_anomaly(star: Star, k: float = params.SIGMA) -> DataFrame:
    """Q5: products whose total sales lie beyond k sample deviations."""
    return sigma_outliers(product_totals(star.lines, star), "total_sales", k).orderBy("product_id")


def _store_product_revenue(star: Star, stores: DataFrame, group_cols=(),
                           few: bool = False) -> DataFrame:
    """``few``: the stores sell few of the products, so lines are reduced to those first."""
    lines = lines_of(star.lines, stores) if few else star.lines
    rev = revenue_by_product(lines, star.product, group_cols, ["product_name"])
    return rev.join(stores.select("store_id", "store_name", "product_id"), "product_id")


def _store_totals(star: Star, stores: DataFrame, few: bool = False) -> DataFrame:
    """Revenue per product, joined to its (store, product) pairs.

    Both store mappings hold each (store, product) pair once by construction
    (one store per product; one product per compat store), so the revenue
    already aggregated per product is the store x product total: no second
    aggregate, no second shuffle."""
    df = _store_product_revenue(star, stores, few=few)
    return df.select("store_id", "product_id", money(F.col("revenue")).alias("store_total"))


def q6_store_product_mv(star: Star) -> DataFrame:
    """Q6 (compat): store x product totals, one product per store."""
    return _store_totals(star, star.store_dim, few=True)


def q6_line(star: Star) -> DataFrame:
    """Q6 at line grain: every product sold in its store."""
    return _store_totals(star, star.product_store)


def _period(by_year: bool) -> list[str]:
    """Months of different years are merged as in the reference, unless
    ``by_year`` keeps them apart."""
    return ["year", "month"] if by_year else ["month"]


def _q7(star: Star, stores: DataFrame, store_name: str, by_year: bool) -> DataFrame:
    chosen = stores.where(F.col("store_name") == store_name)
    period = _period(by_year)
    df = _store_product_revenue(star, chosen, period, few=True)
    return (df.groupBy(*period, "product_id", "product_name")
            .agg(money(F.sum("revenue")).alias("total_sales"))
            .orderBy("product_id", *period))


def q7_store_slice(star: Star, store_name: str = params.STORE_NAME,
                   by_year: bool = False) -> DataFrame:
    """Q7 (compat): slice on one store, product sales by month."""
    return _q7(star, star.store_dim, store_name, by_year)


def q7_line(star: Star, store_name: str = params.STORE_NAME,
            by_year: bool = False) -> DataFrame:
    """Q7 at line grain."""
    return _q7(star, star.product_store, store_name, by_year)


def supplier_month(lines: DataFrame, star: Star, by_year: bool = False) -> DataFrame:
    """Q8 body: supplier x month sales of the given lines."""
    period = _period(by_year)
    rev = revenue_by_product(lines, star.product, period, ["supplier_id"])
    return (rev.join(star.supplier, "supplier_id")
            .groupBy("supplier_id", "supplier_name", *period)
            .agg(money(F.sum("revenue")).alias("monthly_sales")))


def q8_supplier_month_mv(star: Star, by_year: bool = False) -> DataFrame:
    """Q8: supplier x month aggregate table (months of all years merged
    unless ``by_year``)."""
    return supplier_month(star.lines, star, by_year)


def q9_compat(star: Star, year: int = params.YEAR, k: int = params.TOP_K) -> DataFrame:
    """Q9 as the reference: customers joined to lines *on product*.

    The many-to-many join is avoided: lines of the year are reduced to one row
    per product first, then each customer picks up its product's row.
    """
    lines = star.lines_in_year(year)
    prod_rev = revenue_by_product(lines, star.product)
    df = star.customer_dim.join(prod_rev, "product_id")
    # a compat customer has exactly one product and ``prod_rev`` one row per
    # product, so every customer is one row here: its distinct products are 1
    # and its sales are its product's sales; no aggregate, no shuffle
    per_customer = df.select(
        "customer_id", "customer_name", F.lit(1).cast("bigint").alias("unique_products"),
        money(F.col("revenue")).alias("total_sales"))
    return top_k(per_customer, [F.col("total_sales").desc(), F.col("customer_id")], k)


def customer_product_year(lines: DataFrame, star: Star) -> DataFrame:
    """Revenue per distinct (customer, product, year).

    The building block of Q9 that stays additive: SUM merges across batches,
    and a customer's distinct products are the number of its rows, so
    COUNT DISTINCT can be refreshed incrementally from this table."""
    rev = revenue_by_product(lines, star.product, ["customer_id", "year"])
    return rev.select("customer_id", "product_id", "year", money(F.col("revenue")).alias("revenue"))


def q9_from_pairs(pairs: DataFrame, star: Star, year: int = params.YEAR,
                  k: int = params.TOP_K) -> DataFrame:
    """Q9 at line grain from the (customer, product, year) table."""
    agg = pairs.where(F.col("year") == year).groupBy("customer_id").agg(
        F.count(F.lit(1)).cast("bigint").alias("unique_products"),
        money(F.sum("revenue")).alias("total_sales"))
    return q9_ranked(agg, star, k)


def q9_ranked(agg: DataFrame, star: Star, k: int = params.TOP_K) -> DataFrame:
    """The ``k`` customers of ``agg`` (customer_id, unique_products, total_sales) with the highest sales."""
    best = top_k(agg, [F.col("total_sales").desc(), F.col("customer_id")], k)
    names = star.customer.select("customer_id", "customer_name")
    return (best.join(names, "customer_id")
            .select("customer_id", "customer_name", "unique_products", "total_sales")
            .orderBy(F.col("total_sales").desc(), "customer_id"))


def q9_line(star: Star, year: int = params.YEAR, k: int = params.TOP_K) -> DataFrame:
    """Q9 at line grain: a customer's own lines and distinct products."""
    return q9_from_pairs(customer_product_year(star.lines_in_year(year), star), star, year, k)


def _entity_rows(df: DataFrame, id_col: str, tag: str, period: list[str]) -> DataFrame:
    """Rows of one Q10 branch; ``df`` holds one row per (id, period)."""
    return df.select(
        F.col(id_col).cast("bigint").alias("id"), F.lit(tag).alias("entity_type"),
        F.col(id_col).cast("bigint").alias("entity_id"), *period, money(F.col("revenue")).alias("monthly_sales"))


def entity_month(star: Star, lines: DataFrame, grain: str,
                 by_year: bool = False) -> DataFrame:
    """Q10 body: store rows and customer rows by month, one table.

    UNION (distinct) of the reference equals a plain union here: the tag column
    separates the branches and each branch is unique on its group key.
    """
    period = _period(by_year)
    if grain == "line":
        # lines are read once: each meets its product's price and store, and one aggregate
        # (map-side first) gives the groups of both branches
        from .fact import product_lookup
        priced = (lines.select("product_id", "customer_id", "qty", *period)
                  .join(product_lookup(star).drop("known"), "product_id"))
        store = F.grouping("customer_id") == 1
        cells = (priced.groupingSets([["store_id", *period], ["customer_id", *period]],
                                     "store_id", "customer_id", *period)
                 .agg(money(F.sum(F.col("qty") * F.col("price"))).alias("monthly_sales"), store.alias("store")))
        ident = F.when(F.col("store"), F.col("store_id")).otherwise(F.col("customer_id")).cast("bigint")
        return (cells.where("NOT store OR store_id IS NOT NULL")
                .select(ident.alias("id"), F.when(F.col("store"), "Store").otherwise("Customer").alias("entity_type"),
                        ident.alias("entity_id"), *period, "monthly_sales"))
    # a compat store and a compat customer each map to exactly one product,
    # so revenue per (product, period) is already one row per (id, period)
    rev = revenue_by_product(lines, star.product, period)
    stores = rev.join(star.store_dim.select("store_id", "product_id"), "product_id")
    custs = rev.join(star.customer_dim.select("customer_id", "product_id"), "product_id")
    return (_entity_rows(stores, "store_id", "Store", period)
            .unionByName(_entity_rows(custs, "customer_id", "Customer", period)))


def q10_entity_month_mv_compat(star: Star, by_year: bool = False) -> DataFrame:
    """Q10 (compat): stores through their one product, customers through the
    product of their first line (each customer takes that product's sales)."""
    return entity_month(star, star.lines, "compat", by_year)


def q10_entity_month_mv_line(star: Star, by_year: bool = False) -> DataFrame:
    """Q10 at line grain: every line counts for its product's store and for
    its own customer."""
    return entity_month(star, star.lines, "line", by_year)
