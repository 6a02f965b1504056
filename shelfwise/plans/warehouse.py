"""The loaded warehouse: the star written once as parquet tables, then queried.

This is the reference's own shape (a loader fills the warehouse tables, the
analytic queries read them), done with Spark writers:

* ``time_dim`` (the order-line table) is written partitioned by ``year`` and
  sorted by ``product_id`` inside each file, so a year filter is partition
  pruning and product lookups can skip row groups by min/max;
* a dimension is a first-wins log (``aggregates.FirstWinsTable``): the load writes its
  winners as the base version, streams add rows that can still win, and reading takes
  the first row per key.  Without streams that is a plain scan of the base;
* ``sales_fact`` (line grain) is written partitioned by ``year``; lines that make
  no fact row are in ``fact_rejects`` with the reason.  A line whose product comes
  later is written to ``fact_late`` then: it is read as a fact row and no longer as a
  reject.

Each load writes a version folder of its own and then names it in the warehouse's
journal.  Streams (``streaming.warehouse``) add to one version, each batch in
partitions of its own, and keep their checkpoints in it, so that a new version is
filled from the landed files anew.

``WarehouseStar`` offers the same views as ``Star``, so every query in
``plans.queries`` runs unchanged over either.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S
from ..operators.dedup import first_wins_by_id
from ..sources.journal import Journal
from ..sources.paths import holds_batches
from ..sources.star import Star, year_range
from ..streaming.claims import reserve_ids
from ..streaming.runner import batch_partition_write
from .aggregates import FirstWinsTable
from .fact import fact_rejects_line, fact_rows_line

TIME_COLS = tuple(S.TIME_DIM.fieldNames())
#: Tables that streams add to, and the stream name of a load.
GROWING = {"time_dim": S.TIME_DIM, "sales_fact": S.SALES_FACT, "fact_rejects": S.FACT_REJECTS,
           "fact_late": S.SALES_FACT, "rejects": S.REJECTS, "load_audit": S.LOAD_AUDIT, "landed": S.LANDED,
           "violations": S.VIOLATIONS}
LOAD = "load"

#: Dimensions: stored columns, key, values and the order in which the first row wins.
DIMENSIONS = {
    "supplier": (S.SUPPLIER_LOG, "supplier_id", ["supplier_name"], ["row_ord"]),
    "product": (S.PRODUCT_LOG, "product_id", ["product_name", "supplier_id", "price", "store_id", "store_name"],
                ["row_ord"]),
    "store": (S.STORE_LOG, "store_id", ["store_name", "product_id"], ["row_ord"]),
    "customer": (S.CUSTOMER_LOG, "customer_id", ["customer_name", "gender", "product_id", "bought"],
                 ["undated", "order_date", "order_id", "product_id", "qty", "customer_name", "gender"]),
}
#: Tables that are read from a dimension: its name, the columns and the rows.
VIEWS = {
    "supplier_dim": ("supplier", S.SUPPLIER_DIM, None),
    "product_dim": ("product", S.PRODUCT_DIM, None),
    "product_store": ("product", S.PRODUCT_STORE, "store_id IS NOT NULL"),
    "store_dim": ("store", S.STORE_DIM, None),
    "customer_dim": ("customer", S.CUSTOMER_DIM, "bought"),
    "customer": ("customer", S.CUSTOMER, None),
}
#: Batches of a stream after which a dimension's log is folded, and journal entries kept.
FOLD_EVERY, KEEP = 20, 2


def current_version(spark: SparkSession, root: str) -> str:
    """Folder of the warehouse's newest version; ``root`` itself before the first one."""
    entry = Journal(spark, f"{root}/_versions").last()
    return entry["path"] if entry else root


def dimension(spark: SparkSession, base: str, name: str) -> FirstWinsTable:
    """The first-wins log of a dimension in one version."""
    schema, key, values, order = DIMENSIONS[name]
    return FirstWinsTable(spark, f"{base}/{name}", [key], values, FOLD_EVERY, KEEP, schema=schema, order=order)


def read_batches(spark: SparkSession, base: str, name: str) -> DataFrame:
    """A growing table with its stream and batch; it may have no file yet."""
    schema = S.by_batch(GROWING[name])
    if not holds_batches(spark, f"{base}/{name}"):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{base}/{name}")


def late_lines(spark: SparkSession, base: str) -> DataFrame | None:
    """Fact rows of lines whose product came after them, one per line; None without any."""
    if not holds_batches(spark, f"{base}/fact_late"):
        return None
    # a replayed batch may have found the product itself, and two batches that run at the
    # same time may both have found it: a line counts once, and only while it is a reject
    rejects = read_batches(spark, base, "fact_rejects").select("time_id")
    return (read_batches(spark, base, "fact_late").drop("stream", "batch_id")
            .join(rejects, "time_id", "left_semi").dropDuplicates(["time_id"]))


def read_table(spark: SparkSession, base: str, name: str) -> DataFrame:
    """A table as the queries see it, without the columns that only lay out its files."""
    if name in VIEWS:
        source, schema, rows = VIEWS[name]
        df = dimension(spark, base, source).read()
        if "segment" in schema.fieldNames():
            df = df.withColumnRenamed("gender", "segment")
        return S.conform(df.where(rows) if rows else df, schema)
    if name not in GROWING:
        return spark.read.parquet(f"{base}/{name}")
    df = read_batches(spark, base, name).drop("stream", "batch_id")
    late = late_lines(spark, base) if name in ("sales_fact", "fact_rejects") else None
    if late is None:
        return df
    return df.unionByName(late) if name == "sales_fact" else df.join(late.select("time_id"), "time_id", "left_anti")


class VersionWriter:
    """Writes the tables of one new version of a warehouse, then makes it current."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root
        self.folder = f"{root}/v={uuid.uuid4().hex}"
        self.counts: dict[str, int] = {}
        self.intakes: dict[str, Observation] = {}

    def write(self, name: str, df: DataFrame, partition_by: str | None = None,
              sort_by: str | None = None) -> None:
        """Write a table and note its rows, observed on the way.  Tables that
        streams add to are laid out by stream and batch, this load being one."""
        obs = Observation(name)
        df = df.observe(obs, F.count(F.lit(1)).alias("rows"))
        if name in GROWING:
            # partition columns first: the writer then needs no sort of its own
            batch_partition_write(S.conform(df, GROWING[name]), f"{self.folder}/{name}", 0, sort_by, LOAD,
                                  (partition_by,) if partition_by else ())
        else:
            df.write.mode("overwrite").parquet(f"{self.folder}/{name}")
        self.counts[name] = obs.get["rows"]

    def write_dimension(self, name: str, df: DataFrame) -> None:
        """Write the winners of a dimension as its base version; a column of what they won
        by that ``df`` lacks is NULL, which comes before everything that streams bring."""
        schema = DIMENSIONS[name][0]
        obs = Observation(f"{name}_dim")
        # a dimension holds the rows that its table shows; customers without a line are no members of theirs
        shown = F.count_if("bought") if name == "customer" else F.count(F.lit(1))
        df = df.withColumns({f.name: F.lit(None) for f in schema if f.name not in df.columns})
        dimension(self.spark, self.folder, name).refresh_full(
            S.conform(df, schema).observe(obs, shown.alias("rows")), {})
        self.counts[f"{name}_dim"] = obs.get["rows"]

    def intake(self, name: str, rows: DataFrame, ok: Column) -> DataFrame:
        """The rows that can stand in table ``name``; all and the unusable ones are
        counted when the table is written."""
        seen = Observation(f"{name}_intake")
        self.intakes[name] = seen
        return rows.observe(seen, F.count(F.lit(1)).alias("attempted"),
                            F.count_if(~ok).alias("rejected")).where(ok)

    def write_audit(self, more: list[tuple]) -> None:
        """``load_audit``: attempted, loaded, rejected and repeated rows per table."""
        rows = [(name, seen.get["attempted"], self.counts[f"{name}_dim"], seen.get["rejected"])
                for name, seen in self.intakes.items()] + more
        self.write("load_audit", self.spark.createDataFrame(
            [(*r, r[1] - r[2] - r[3]) for r in rows], S.LOAD_AUDIT).coalesce(1))

    def read(self, name: str) -> DataFrame:
        return read_table(self.spark, self.folder, name)

    def write_fact(self) -> None:
        """The line fact and the lines that make no fact row: together all lines."""
        star = WarehouseStar(self.spark, self.root, base=self.folder)
        self.write("sales_fact", S.conform(fact_rows_line(star), S.SALES_FACT), "year", "product_id")
        self.write("fact_rejects", fact_rejects_line(star))

    def publish(self) -> None:
        """Claim the ids of the loaded lines, from which streams go on, and switch to this version."""
        last = self.read("time_dim").agg(F.coalesce(F.max("time_id"), F.lit(0))).first()[0]
        reserve_ids(self.spark, f"{self.folder}/ids", LOAD, 0, last)
        Journal(self.spark, f"{self.root}/_versions").append(lambda _: {"path": self.folder})


def load_warehouse(star: Star, root: str) -> dict[str, int]:
    """Write a new version of every table of the warehouse under ``root``; returns
    row counts observed while writing (no second pass)."""
    out = VersionWriter(star.spark, root)
    # the keyed lines come range-partitioned on the total order, which starts
    # with the order date: each task holds a contiguous run of dates, so it
    # writes into one or two year folders without another shuffle, and no
    # product, however hot, lands in a single task
    out.write("time_dim", S.conform(star.time_dim, S.TIME_DIM), "year", "product_id")
    out.write_dimension("product", star.product.join(star.product_store, "product_id", "left"))
    out.write_dimension("supplier", star.supplier)
    out.write_dimension("store", star.store_dim)
    # first line of a customer = lowest time id: the dense key already encodes
    # the total order, so the stored lines give the compat dimension by a hash
    # aggregate instead of a struct-ordered one over the raw lines
    firsts = first_wins_by_id(out.read("time_dim"), ["customer_id"], "time_id", ["product_id"])
    out.write_dimension("customer", star.customer.withColumnRenamed("segment", "gender").join(
        firsts.withColumn("bought", F.lit(True)), "customer_id", "left")
        .withColumn("bought", F.coalesce("bought", F.lit(False))))
    out.write_fact()
    out.publish()
    return out.counts


@dataclass
class WarehouseStar:
    spark: SparkSession
    root: str
    order_filter: Column | None = None
    base: str | None = None   # version folder; the current one of ``root`` by default

    def __post_init__(self):
        if self.base is None:
            self.base = current_version(self.spark, self.root)

    def _t(self, name: str) -> DataFrame:
        return read_table(self.spark, self.base, name)

    @property
    def lines(self) -> DataFrame:
        df = self._t("time_dim")
        return df.where(self.order_filter) if self.order_filter is not None else df

    def lines_base(self) -> DataFrame:
        return self.lines

    def lines_filtered(self, pred: Column) -> DataFrame:
        return self.lines.where(pred)

    def lines_in_year(self, year: int) -> DataFrame:
        # the partition column prunes files; the range keeps the meaning exact
        return self.lines.where((F.col("year") == year) & year_range("order_date", year))

    def refreshed(self) -> "WarehouseStar":
        return WarehouseStar(self.spark, self.root, self.order_filter)

    @property
    def product(self) -> DataFrame:
        return self._t("product_dim")

    @property
    def priced_products(self) -> DataFrame:
        """Price and store of every product, from one scan of the stored dimension."""
        return dimension(self.spark, self.base, "product").read().select(
            "product_id", "price", F.lit(True).alias("known"), "store_id")

    @property
    def supplier(self) -> DataFrame:
        return self._t("supplier_dim")

    @property
    def product_store(self) -> DataFrame:
        return self._t("product_store")

    @property
    def store_dim(self) -> DataFrame:
        return self._t("store_dim")

    @property
    def customer(self) -> DataFrame:
        return self._t("customer")

    @property
    def customer_dim(self) -> DataFrame:
        return self._t("customer_dim")

    @property
    def first_products(self) -> DataFrame:
        return self.customer_dim.select("customer_id", "product_id")

    @cached_property
    def time_dim(self) -> DataFrame:
        return self.lines

    @property
    def sales_fact(self) -> DataFrame:
        return self._t("sales_fact")
