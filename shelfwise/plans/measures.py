"""Measures that do not add up by themselves, kept batch by batch.

* Distinct counts (D4): a sketch per group.  Sketches merge, so a batch stores its own and
  reading unites them; their size depends on the wanted error, not on what is counted.
* Mean and deviation of group totals (D12, E1, E2): count, sum and sum of squares of the
  totals.  A batch that changes a total takes its old square back and adds the new one.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from decimal import Decimal, localcontext

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.olap import money
from ..sources.journal import Journal
from .aggregates import AggregateTable


@dataclass
class SketchTable(AggregateTable):
    """SUM measures and a distinct count (``counted``, a HyperLogLog sketch) by ``keys``.

    ``log_size``: a sketch has 2**log_size buckets; the standard error of an estimate is
    about 1.04 / sqrt(2**log_size), and counts up to about an eighth of that
    are kept as they are."""
    counted: str = "sketch"
    log_size: int = 12

    @property
    def error(self) -> float:
        """Relative standard error of an estimate."""
        return 1.04 / math.sqrt(2 ** self.log_size)

    def sketched(self, rows: DataFrame, column: str) -> DataFrame:
        """``rows`` grouped by the keys, with the measures summed and ``column`` sketched."""
        return rows.groupBy(*self.keys).agg(
            *[money(F.sum(m)).alias(m) for m in self.measures],
            F.hll_sketch_agg(column, self.log_size).alias(self.counted))

    def _regroup(self, df: DataFrame) -> DataFrame:
        return df.groupBy(*self.keys).agg(
            *[money(F.sum(m)).alias(m) for m in self.measures],
            F.hll_union_agg(self.counted).alias(self.counted))

    def estimates(self, name: str) -> DataFrame:
        """The table with the distinct count ``name`` in place of the sketch."""
        return self.read().withColumn(name, F.hll_sketch_estimate(self.counted)).drop(self.counted)


class MomentTable:
    """Totals by ``keys`` under ``root``, with the moments of all totals kept beside them.

    Each entry of a journal holds the moments after one more batch and the batches that
    they cover.  A batch's change is worked out against the totals of exactly those
    batches; if another stream has appended in the meantime it is worked out again, so
    streams may take turns or run at the same time, and a replayed batch changes nothing."""

    def __init__(self, spark: SparkSession, root: str, keys: list[str], measure: str):
        self.totals = AggregateTable(spark, f"{root}/totals", keys, [measure])
        self.journal, self.measure = Journal(spark, f"{root}/_moments"), measure

    def _state(self) -> dict:
        return self.journal.last() or {"marks": {}, "n": 0, "s1": "0", "s2": "0"}

    def apply_batch(self, partial: DataFrame, batch_id: int, stream: str = "main") -> None:
        """Add a batch of totals (one row per key).  Its partial is written first and counts from
        the moment that an entry covers it."""
        if batch_id <= self._state()["marks"].get(stream, -1):
            return
        self.totals.apply_batch(partial, batch_id, stream)
        own = (F.col("stream") == stream) & (F.col("batch_id") == batch_id)
        _, added = self.totals._stored(own)
        while True:
            state = self._state()
            change = (0, 0, 0) if added is None else self._change(added, state["marks"])
            after = {"marks": {**state["marks"], stream: batch_id}, "n": state["n"] + change[0],
                     "s1": str(Decimal(state["s1"]) + change[1]), "s2": str(Decimal(state["s2"]) + change[2])}
            if self.journal.append(lambda last, seen=state, after=after: after if (last or {}).get(
                    "marks", {}) == seen["marks"] else None) is not None:
                return

    def _change(self, added: DataFrame, marks: dict[str, int]) -> tuple[int, Decimal, Decimal]:
        """What the batch does to count, sum and sum of squares: the totals that it touches, before and after."""
        m, keys = self.measure, self.totals.keys
        added = added.select(*keys, F.col(m).alias("more"))
        if marks:
            # the stored totals are first reduced to the keys of the batch
            before = self.totals.read(marks).join(added.select(*keys), keys, "left_semi")
            added = added.join(before.select(*keys, F.col(m).alias("old")), keys, "left")
        else:
            added = added.withColumn("old", F.lit(None).cast(added.schema["more"].dataType))
        more, old = F.col("more").cast("decimal(18,2)"), F.coalesce("old", F.lit(0)).cast("decimal(18,2)")
        # (old + more)^2 - old^2, exact: a product of 18 digits each has 37 at most
        square = more * (old + old + more).cast("decimal(18,2)")
        got = added.agg(F.count_if(F.col("old").isNull()).alias("n"), F.sum(more).alias("s1"),
                        F.sum(square).alias("s2")).first()
        return got.n, got.s1 or Decimal(0), got.s2 or Decimal(0)

    def read(self) -> DataFrame:
        """The totals that the moments cover."""
        return self.totals.read(self._state()["marks"])

    def moments(self) -> tuple[int, float, float | None]:
        """Count, mean and sample standard deviation of all totals (no deviation of fewer than two)."""
        state = self._state()
        with localcontext() as context:
            context.prec = 80
            n, s1, s2 = state["n"], Decimal(state["s1"]), Decimal(state["s2"])
            if n < 2:
                return n, float(s1), None
            return n, float(s1 / n), float(((s2 - s1 * s1 / n) / (n - 1)).sqrt())

    def outliers(self, k: float) -> DataFrame:
        """Totals more than ``k`` deviations from the mean, without a pass over all totals for either."""
        _, mean, deviation = self.moments()
        rows = self.read()
        if deviation is None:
            return rows.limit(0)
        return rows.where(F.abs(F.col(self.measure).cast("double") - F.lit(mean)) > F.lit(k * deviation))
