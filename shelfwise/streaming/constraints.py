"""Key constraints checked batch by batch, without reading the stored tables whole.

A batch's lines are looked up in a stored filter of all lines before them (a Bloom filter
of one 64-bit word per block, kept like an aggregate table: batches add their own
bits, folds unite them).  What the filter has not seen is new for certain.  Only what it
may have seen is compared with the stored lines, and of those only the years and the range
of orders in question are read.  Products and customers are looked up in the
dimensions, reduced to the batch's keys first.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S
from ..plans.aggregates import AggregateTable
from ..plans.warehouse import FOLD_EVERY, KEEP, WarehouseStar, dimension, read_batches
from .runner import batch_partition_write, before_batch

#: What makes two order lines the same line (files carry no line number).
LINE_KEY = ("order_id", "product_id", "customer_id", "order_date", "qty")
#: Blocks of the filter for each year of lines: about 16 bits a line with 4 million lines a year.
BLOCKS = 1 << 20
REPEATED, NO_PRODUCT, NO_CUSTOMER = "repeated line", "product of a line", "customer of a line"


@dataclass
class LineFilter(AggregateTable):
    """Bits of all lines by (year, block); reading unites the batches' bits."""
    keys: list[str] = field(default_factory=lambda: ["year", "block"])
    measures: list[str] = field(default_factory=lambda: ["bits"])

    def _regroup(self, df: DataFrame) -> DataFrame:
        return df.groupBy(*self.keys).agg(F.bit_or("bits").alias("bits"))


def line_filter(spark: SparkSession, base: str) -> LineFilter:
    return LineFilter(spark, f"{base}/line_filter", compact_every=FOLD_EVERY, retain=KEEP)


def _place(blocks: int) -> tuple[Column, Column]:
    """(block, the four bits in it) of a line."""
    h, g = F.xxhash64(*LINE_KEY), F.xxhash64(F.lit(1), *LINE_KEY)
    bits = None
    for shift in (0, 6, 12, 18):
        one = F.expr("1L").cast("long")
        bit = F.call_function("shiftleft", one, F.shiftright(g, shift).bitwiseAND(F.lit(63)).cast("int"))
        bits = bit if bits is None else bits.bitwiseOR(bit)
    return F.pmod(h, F.lit(blocks)).alias("block"), bits.alias("bits")


def maybe_seen(spark: SparkSession, base: str, lines: DataFrame, batch_id: int, stream: str,
               blocks: int = BLOCKS) -> DataFrame:
    """Keys and years of the lines that an earlier batch may have brought; all that one has are among them."""
    own = lines.select("year", *LINE_KEY, *_place(blocks)).distinct()
    stored = line_filter(spark, base).rows(before_batch(stream, batch_id))
    if stored is None:
        return own.select("year", *LINE_KEY).limit(0)
    # the filter is reduced to the blocks of the batch, and what is left of it united
    mine = (stored.join(own.select("year", "block").distinct(), ["year", "block"], "left_semi")
            .groupBy("year", "block").agg(F.bit_or("bits").alias("held")))
    return (own.join(mine, ["year", "block"])
            .where(F.col("held").bitwiseAND(F.col("bits")) == F.col("bits")).select("year", *LINE_KEY))


def same_lines(spark: SparkSession, base: str, suspects: DataFrame, batch_id: int, stream: str) -> DataFrame:
    """Those of ``suspects`` (year and line key) that an earlier batch has stored: the exact test.

    Reads the stored lines of the suspects' years and range of orders only."""
    span = suspects.agg(F.collect_set("year").alias("years"), F.min("order_id").alias("low"),
                        F.max("order_id").alias("high")).first()  # as many values as there are years
    if not span.years:
        return suspects.limit(0)
    stored = (read_batches(spark, base, "time_dim").where(F.col("year").isin(span.years))
              .where(F.col("order_id").between(span.low, span.high)).where(before_batch(stream, batch_id)))
    near = stored.select("year", *LINE_KEY)
    equal = [suspects[c].eqNullSafe(near[c]) for c in ("year", *LINE_KEY)]
    condition = equal[0]
    for c in equal[1:]:
        condition = condition & c
    return suspects.join(near, condition, "left_semi")


def check_batch(wh: WarehouseStar, lines: DataFrame, batch_id: int, stream: str, blocks: int = BLOCKS) -> None:
    """Write the violations of a batch of stored lines (``violations``), then add it to the filter.

    One row per violating key: the constraint, and the key as JSON.  A replayed batch replaces
    its own rows; batches that its stream has brought since do not count against it."""
    spark, base = wh.spark, wh.base
    lines = lines.select("year", *LINE_KEY).persist()
    try:
        suspects = maybe_seen(spark, base, lines, batch_id, stream, blocks).persist()
        again = lines.groupBy(*LINE_KEY).count().where("count > 1").select(*LINE_KEY)
        repeated = same_lines(spark, base, suspects, batch_id, stream).select(*LINE_KEY).union(again).distinct()
        found = repeated.select(F.lit(REPEATED).alias("constraint"), F.to_json(F.struct(*LINE_KEY)).alias("key"))
        for name, of, text in ((("product_id"), "product", NO_PRODUCT), ("customer_id", "customer", NO_CUSTOMER)):
            keys = lines.select(name).where(F.col(name).isNotNull()).distinct()
            known = dimension(spark, base, of).read().select(name).join(keys, name, "left_semi")
            found = found.union(keys.join(known, name, "left_anti").select(
                F.lit(text), F.to_json(F.struct(name))))
        batch_partition_write(S.conform(found, S.VIOLATIONS), f"{base}/violations", batch_id, stream=stream)
        suspects.unpersist()
        bits = lines.select("year", *_place(blocks)).groupBy("year", "block").agg(F.bit_or("bits").alias("bits"))
        line_filter(spark, base).apply_batch(bits.sortWithinPartitions("year", "block"), batch_id, stream)
    finally:
        lines.unpersist()


def seed_filter(wh: WarehouseStar, blocks: int = BLOCKS) -> None:
    """Fill the filter of a version with the lines of its load; once, before its first checked stream."""
    table = line_filter(wh.spark, wh.base)
    if table.current()[0] is None:
        lines = read_batches(wh.spark, wh.base, "time_dim").where("stream = 'load'").select("year", *_place(blocks))
        table.refresh_full(lines.groupBy("year", "block").agg(F.bit_or("bits").alias("bits")), table.current()[1])
