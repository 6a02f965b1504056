"""Control of a stream's batch size by its arrival and service rates (K3).

A listener hears how long each batch took, the rates are stored with the files that the
batch took and those that had arrived since the batch before, and a controller sets the next
batch's file limit from them: as many files as the sink serves in the wanted time, within
bounds, and never more than doubled or less than halved at once.  Each batch is one
short run of the query on the same checkpoint, because a source's limit is fixed while
its query runs; state and offsets live in the checkpoint.  The time that such a run takes around
its sink (start, listing, logs) is the same for any limit: it is part of the batch's seconds and not of the
rate, as it would only make batches smaller, and more of them.
"""

from __future__ import annotations

import time
from collections import deque
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from ..sources.paths import read_parquet_if_exists
from .runner import batch_partition_write

RATES = ("input_rows long, files long, seconds double, served_per_second double, arrived_per_second double, "
         "file_limit long, next_limit long")


@dataclass
class RateControl:
    """The file limit that lets the sink take about ``seconds`` a batch.

    A sink has a fixed part too (planning, lookups), which the line through its latest batches shows.  Files get
    the time beside it, and as much as it takes at least: batches below that would serve fewer files a second, and
    if it takes longer than ``seconds``, no limit would ever be small enough.

    ``smooth``: weight of the newest batch in the rates."""
    seconds: float
    least: int = 1
    most: int = 1000
    limit: int = 10
    smooth: float = 0.6
    served: float | None = field(default=None, init=False)   # files a second
    arrived: float | None = field(default=None, init=False)
    fixed: float = field(default=0.0, init=False)            # seconds of a batch that its rows do not ask for
    beside: float | None = field(default=None, init=False)   # files a second, without the fixed part
    past: deque = field(default_factory=lambda: deque(maxlen=8), init=False)

    def __post_init__(self):
        self.limit = min(max(self.limit, self.least), self.most)

    def _mixed(self, old: float | None, new: float) -> float:
        return new if old is None else self.smooth * new + (1 - self.smooth) * old

    def _fixed_part(self, rows: int, seconds: float) -> float:
        """Least squares over the latest batches; what was known before, where these are all of one size."""
        self.past.append((rows, seconds))
        n, x, y = len(self.past), [r for r, _ in self.past], [s for _, s in self.past]
        spread = n * sum(r * r for r in x) - sum(x) ** 2
        if n < 3 or not spread:
            return self.fixed
        slope = (n * sum(r * s for r, s in self.past) - sum(x) * sum(y)) / spread
        return min(max((sum(y) - slope * sum(x)) / n, 0.0), min(y)) if slope > 0 else 0.0

    def heard(self, files: int, seconds: float, arrived: float, rows: int | None = None) -> int:
        """Note a batch (its files, its sink's time, files that arrived a second, its rows) and return the next
        limit; without ``rows`` no part of the time counts as fixed."""
        self.served = self._mixed(self.served, files / max(seconds, 1e-6))
        self.arrived = self._mixed(self.arrived, arrived)
        if rows:
            self.fixed = self._fixed_part(rows, seconds)
        self.beside = self._mixed(self.beside, files / max(seconds - self.fixed, seconds / 10, 1e-6))
        wanted = int(self.beside * max(self.seconds - self.fixed, self.fixed) + 1e-9)  # 6 files stay 6 files
        if files < self.limit:  # the batch was not full: it says nothing about larger ones
            wanted = min(wanted, self.limit)
        wanted = min(max(wanted, -(-self.limit // 2)), 2 * self.limit)
        self.limit = min(max(wanted, self.least), self.most)
        return self.limit

    @property
    def falls_behind(self) -> bool:
        """More arrives than is served."""
        return self.arrived is not None and self.served is not None and self.arrived > self.served

    def resume(self, spark: SparkSession, path: str, stream: str = "main") -> RateControl:
        """Go on from the rates that an earlier run of the stream has stored."""
        rates = read_parquet_if_exists(spark, path)
        last = rates and (rates.where(F.col("stream") == stream).orderBy(F.col("batch_id").desc()).first())
        if last:
            self.served, self.arrived = last.served_per_second, last.arrived_per_second
            self.beside = self.served
            self.limit = min(max(last.next_limit, self.least), self.most)
        return self


class BatchTimes(StreamingQueryListener):
    """Hears the time that each batch of a query took, by run and batch."""

    def __init__(self):
        self.seconds: dict[tuple[str, int], float] = {}

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        if "addBatch" in p.durationMs:  # a batch ran, though its files may hold no row
            self.seconds[str(p.runId), p.batchId] = p.durationMs["triggerExecution"] / 1000

    def onQueryTerminated(self, event) -> None:
        pass

    def of(self, run: str, batch: int, wait: float = 30.0) -> float | None:
        """Seconds of a batch; reports come a little after it."""
        end = time.monotonic() + wait
        while (run, batch) not in self.seconds and time.monotonic() < end:
            time.sleep(0.01)
        return self.seconds.get((run, batch))


def file_source(spark: SparkSession, schema, path: str) -> Callable[[int], DataFrame]:
    """A folder of parquet files as a source whose file limit can be set."""
    def source(limit: int) -> DataFrame:
        return (spark.readStream.schema(schema).option("maxFilesPerTrigger", limit).parquet(path)
                .select("*", F.col("_metadata.file_path").alias("file"),
                        F.col("_metadata.file_modification_time").alias("landed_at")))
    return source


def _one_batch(stream: DataFrame, sink, checkpoint: str) -> str:
    """Run the query until its first trigger is over (one batch, or none if nothing is there); its run id."""
    q = (stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
         .trigger(processingTime="1 day").start())
    try:
        while q.isActive and (q.status["isTriggerActive"] or not q.status["message"].startswith("Waiting")):
            time.sleep(0.02)
    finally:
        q.stop()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return str(q.runId)


def run_controlled(spark: SparkSession, source: Callable[[int], DataFrame], sink: Callable[[DataFrame, int], None],
                   checkpoint: str, rates: str, control: RateControl, stream: str = "main") -> int:
    """Drain ``source`` (file limit -> streaming DataFrame with ``file`` and ``landed_at``, see
    :func:`file_source`), one batch after another, each under the limit that ``control`` has
    set; returns the number of batches.

    The rates of each batch are stored at ``rates``, and a later run goes on from them.  A batch
    whose files hold no row says nothing about rates and leaves the limit as it is."""
    times, batches, control = BatchTimes(), 0, control.resume(spark, rates, stream)
    spark.streams.addListener(times)
    try:
        arrived_at = time.time()
        while True:
            taken: dict[int, Row] = {}
            served_in: dict[int, float] = {}

            def seen(batch: DataFrame, batch_id: int, taken=taken, served_in=served_in) -> None:
                # one row per file first; a pass of its own over names and times: metrics
                # observed in the sink's plan are lost where Spark finds an empty batch
                by_file = batch.groupBy("file").agg(F.count(F.lit(1)).alias("rows"), F.max("landed_at").alias("newest"),
                                                    F.min("landed_at").alias("oldest"))
                taken[batch_id] = by_file.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"), F.count("file").alias("files"),
                                              F.max("newest").alias("newest"), F.min("oldest").alias("oldest")).first()
                began = time.perf_counter()
                sink(batch, batch_id)
                served_in[batch_id] = time.perf_counter() - began

            limit = control.limit
            run = _one_batch(source(limit), seen, checkpoint)
            if not taken:
                return batches
            [(batch_id, got)] = taken.items()
            seconds, following = times.of(run, batch_id) or time.time() - arrived_at, limit
            if got.rows:
                spread = (got.newest - got.oldest).total_seconds()
                arrived = got.files / max(spread, 1e-3) if got.files > 1 else control.arrived or 0.0
                following = control.heard(got.files, served_in[batch_id], arrived, got.rows)
            row = (got.rows, got.files, seconds, control.served, control.arrived, limit, following)
            # made of literals: rows from Python would be unpickled by a task
            batch_partition_write(spark.range(1).coalesce(1).select(
                *[F.lit(v).cast(f.split()[1]).alias(f.split()[0]) for v, f in zip(row, RATES.split(", "))]),
                rates, batch_id, stream=stream)
            batches, arrived_at = batches + 1, time.time()
    finally:
        spark.streams.removeListener(times)
