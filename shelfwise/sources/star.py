"""The star schema over the driver's tables (FIXTURES.md section 2).

``lines`` is the order-line table (the reference's Time_Dimension without its
surrogate key): lineitem joined to orders, one row per line, with calendar
columns.  Dimensions are views over part, supplier, nation and customer.  The
compat dimensions (one product per store, the first product of a customer)
reproduce the reference's odd grain; the line-grain mapping ``product_store``
is what an analyst means.

Nothing here carries a broadcast hint: every dimension grows with the data, so
the join strategy is left to AQE, which broadcasts a side only when its
measured size is under the threshold and keeps a shuffle join otherwise.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import calendar_columns
from ..schemas import PRICE
from .tables import Tables, load_tables

# fixed values: the total order of order lines (no ties in the test tables)
LINE_ORDER = ("order_date", "order_id", "line_number", "product_id",
              "line_supplier_id", "ship_date", "ext_price")


def year_range(col: str | Column, year: int) -> Column:
    """``year(col) = y`` written as a half-open range so it reaches the scan."""
    c = F.col(col) if isinstance(col, str) else col
    lo = F.lit(f"{year:04d}-01-01 00:00:00").cast("timestamp_ntz")
    hi = F.lit(f"{year + 1:04d}-01-01 00:00:00").cast("timestamp_ntz")
    return (c >= lo) & (c < hi)


@dataclass
class Star:
    """Star views computed from the driver's raw tables on every use."""
    t: Tables
    order_filter: Column | None = None   # predicate on order_date, pushed to the scan

    @property
    def spark(self):
        return self.t.spark

    def with_order_filter(self, pred: Column) -> "Star":
        return Star(self.t, pred)

    def refreshed(self) -> "Star":
        """The same views over a fresh read of the tables (new file listing)."""
        return Star(load_tables(self.t.spark, self.t.sf_dir), self.order_filter)

    def lines_in_year(self, year: int) -> DataFrame:
        """Order lines of one year (a range on the order date: pushed down)."""
        return self.lines_filtered(year_range("order_date", year))

    @property
    def customer(self) -> DataFrame:
        return self.t.customer.select(
            F.col("c_custkey").alias("customer_id"),
            F.col("c_name").alias("customer_name"),
            F.col("c_mktsegment").alias("segment"))

    # ---- order lines -----------------------------------------------------
    def lines_base(self, hint: str | None = None) -> DataFrame:
        """lineitem ⋈ orders with the columns of the total order.  ``hint``: how to join the orders."""
        orders = self._orders()
        return self._lineitem().join(orders.hint(hint) if hint else orders, "order_id")

    def _orders(self) -> DataFrame:
        o = self.t.orders.select(
            F.col("o_orderkey").alias("order_id"),
            F.col("o_orderdate").alias("order_date"),
            F.col("o_custkey").alias("customer_id"))
        # reaches the scan through the alias
        return o if self.order_filter is None else o.where(self.order_filter)

    def _lineitem(self) -> DataFrame:
        return self.t.lineitem.select(
            F.col("l_orderkey").alias("order_id"),
            F.col("l_linenumber").alias("line_number"),
            F.col("l_partkey").alias("product_id"),
            F.col("l_suppkey").alias("line_supplier_id"),
            F.col("l_shipdate").alias("ship_date"),
            F.col("l_extendedprice").alias("ext_price"),
            # a quantity that is not whole is no quantity: NULL, never cut
            F.when(F.col("l_quantity") == F.floor("l_quantity"), F.col("l_quantity"))
            .try_cast("int").alias("qty"))

    @property
    def lines(self) -> DataFrame:
        base = self.lines_base()
        cal = calendar_columns("order_date")
        return base.select("*", *[c.alias(n) for n, c in cal.items()])

    @property
    def sales_fact(self) -> DataFrame:
        from ..plans.fact import fact_rows_line
        return fact_rows_line(self)

    def lines_filtered(self, pred: Column) -> DataFrame:
        return self.with_order_filter(pred).lines

    # ---- dimensions ------------------------------------------------------
    @property
    def supplier(self) -> DataFrame:
        return self.t.supplier.select(
            F.col("s_suppkey").alias("supplier_id"),
            F.col("s_name").alias("supplier_name"))

    @property
    def product(self) -> DataFrame:
        # supplier of a part: p_partkey modulo the number of suppliers, a
        # scalar subquery (one aggregate row, no join)
        n_sup = self.t.supplier.select(F.count(F.lit(1))).scalar()
        return self.t.part.select(
            F.col("p_partkey").alias("product_id"),
            F.col("p_name").alias("product_name"),
            (F.col("p_partkey") % n_sup).alias("supplier_id"),
            F.col("p_retailprice").cast(PRICE).alias("price"))

    @property
    def product_store(self) -> DataFrame:
        """Line-grain store of a product: the nation of its supplier, id + 1."""
        sup = self.t.supplier.select(F.col("s_suppkey").alias("supplier_id"),
                                     F.col("s_nationkey").alias("nation_id"))
        nat = self.t.nation.select(F.col("n_nationkey").alias("nation_id"),
                                   F.col("n_name").alias("store_name"))
        return (self.product.select("product_id", "supplier_id")
                .join(sup, "supplier_id")
                .join(nat, "nation_id")
                .select("product_id", (F.col("nation_id") + 1).alias("store_id"),
                        "store_name"))

    @property
    def store_dim(self) -> DataFrame:
        """Compat store dimension: one (the smallest) product per store."""
        return (self.product_store.groupBy("store_id")
                .agg(F.min(F.struct("product_id", "store_name")).alias("m"))
                .select("store_id", F.col("m.store_name").alias("store_name"),
                        F.col("m.product_id").alias("product_id")))

    @property
    def customer_dim(self) -> DataFrame:
        """Compat customer dimension: the product of the customer's first line.

        First-wins is a ``min`` over a struct that starts with the total-order
        columns: an aggregate with a map-side partial step (sorted within each
        task, no global sort, no window), so a customer with a third of all
        lines still leaves each map task as one row.  The total order starts with
        an order's own columns, so an order's first line is found before the join,
        and one row per order is shuffled instead of all its lines.
        """
        from ..operators.dedup import first_wins
        within = [c for c in LINE_ORDER if c not in ("order_date", "order_id")]
        of_order = first_wins(self._lineitem(), ["order_id"], within, within)
        first = first_wins(of_order.join(self._orders(), "order_id"), ["customer_id"], LINE_ORDER, ["product_id"])
        return (first.join(self.customer, "customer_id")
                .select("customer_id", "customer_name", "segment", "product_id"))

    @property
    def first_products(self) -> DataFrame:
        """The customer and product columns of ``customer_dim``, from the keyed lines: the lowest
        ``time_id`` of a customer is its first line, and no second join of the order lines is needed."""
        from ..operators.dedup import first_wins_by_id
        firsts = first_wins_by_id(self.time_dim, ["customer_id"], "time_id", ["product_id"])
        return firsts.join(self.customer.select("customer_id"), "customer_id").select("customer_id", "product_id")

    @cached_property
    def time_dim(self) -> DataFrame:
        """Order lines with the dense surrogate key ``time_id`` (1..n in the
        total order) and the customer (added for line grain).  The keyed rows
        are written once to the shared checkpoint folder by the surrogate-key
        operator, so every reader sees the same ids."""
        from ..operators.surrogate import dense_key
        keyed = dense_key(self.lines, LINE_ORDER, "time_id")
        return keyed

    @cached_property
    def landed_lines(self) -> DataFrame:
        """The columns of ``time_dim`` that streams of keyed lines bring, with the same ids: only these are
        written, and the calendar is worked out from the date behind it.  The key samples its input, so the join
        runs twice: it is hashed, as its rows are sorted anew anyway."""
        from ..operators.surrogate import dense_key
        cal = calendar_columns("order_date")
        keyed = dense_key(self.lines_base("shuffle_hash"), LINE_ORDER, "time_id",
                          keep=["order_id", "order_date", "qty", "product_id", "customer_id"])
        return keyed.select("time_id", "order_id", "order_date", cal["year"].alias("year"), cal["month"].alias("month"),
                            "qty", "product_id", "customer_id")


def build_star(spark, sf_dir: str) -> Star:
    """Star views over the raw tables in ``sf_dir``."""
    return Star(load_tables(spark, sf_dir))
