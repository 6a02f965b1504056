"""Drive a Structured Streaming query over staged files.

Each range of rows is staged, then the query runs with
``trigger(availableNow=True)`` on the same checkpoint: it picks up exactly the
new files as one micro-batch and stops.  This is how data arriving over time
reaches a file source; restarting from the checkpoint each time also proves
the query resumes where it stopped (the recovery path after a failure).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from ..sources.paths import file_names, remove_folder, subfolders
from ..sources.staging import range_bounds, write_range


@dataclass
class StreamRun:
    source: str
    checkpoint: str
    progress: list = field(default_factory=list)
    run_ids: list = field(default_factory=list)

    @property
    def batches(self) -> int:
        """Batches that held rows.  Reports of a long run are trimmed to its latest ones, but a file
        source counts its batches from 0 and makes none without files."""
        return 1 + max((b for b, *_ in progress_rows(self.progress)), default=-1)


def _get(p, name, default=None):
    if isinstance(p, dict):
        return p.get(name, default)
    return getattr(p, name, default)


def progress_rows(progress: list) -> list[tuple]:
    out = []
    for p in progress:
        n = _get(p, "numInputRows", 0) or 0
        if n <= 0:
            continue
        out.append((int(_get(p, "batchId", -1)), int(n),
                    float(_get(p, "inputRowsPerSecond", 0.0) or 0.0),
                    float(_get(p, "processedRowsPerSecond", 0.0) or 0.0)))
    return out


def run_ranges(spark: SparkSession, staged: DataFrame, key: str, n_ranges: int | None,
               root: str, sink: Callable[[DataFrame, int], None],
               transform: Callable[[DataFrame], DataFrame] | None = None,
               max_files_per_trigger: int | None = None,
               rows_per_batch: int | None = None, descending: bool = False) -> StreamRun:
    """Stage ``staged`` in ranges of the dense ``key`` under ``root`` (either
    ``n_ranges`` of them or ranges of ``rows_per_batch`` rows, the reference's
    batch size); after each, run the stream once (availableNow) with ``sink``
    as foreachBatch.  ``descending`` stages the last range first (late data)."""
    run = StreamRun(f"{root}/source", f"{root}/checkpoint")
    schema = staged.schema
    bounds = range_bounds(staged, key, n_ranges, rows_per_batch)
    for lo, hi in (reversed(bounds) if descending else bounds):
        write_range(staged, key, lo, hi, run.source)
        reader = spark.readStream.schema(schema)
        if max_files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
        stream = reader.parquet(run.source)
        if transform is not None:
            stream = transform(stream)
        q = (stream.writeStream.foreachBatch(sink)
             .option("checkpointLocation", run.checkpoint)
             .trigger(availableNow=True).start())
        q.awaitTermination()
        if q.exception() is not None:
            raise RuntimeError(str(q.exception()))
        run.progress.extend(q.recentProgress)
        run.run_ids.append(str(q.runId))
    return run


def stage_ranges(spark: SparkSession, staged: DataFrame, key: str, n: int,
                 source: str) -> int:
    """Write ``n`` ranges of the dense ``key`` to ``source``, one write each, in
    order; returns the number of files staged (from the file listing)."""
    for lo, hi in range_bounds(staged, key, n):
        write_range(staged, key, lo, hi, source)
    return len(spark.read.schema(staged.schema).parquet(source).inputFiles())


def run_available(spark: SparkSession, schema, source: str, checkpoint: str,
                  sink: Callable[[DataFrame, int], None], files_per_batch: int,
                  transform: Callable[[DataFrame], DataFrame] | None = None
                  ) -> tuple[list, str]:
    """One ``availableNow`` query over everything in ``source``, at most
    ``files_per_batch`` files per micro-batch; returns its progress reports
    and its run id."""
    stream = (spark.readStream.schema(schema)
              .option("maxFilesPerTrigger", files_per_batch).parquet(source))
    if transform is not None:
        stream = transform(stream)
    q = (stream.writeStream.foreachBatch(sink)
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return list(q.recentProgress), str(q.runId)


def run_staged(spark: SparkSession, staged: DataFrame, key: str, n_batches: int,
               root: str, sink: Callable[[DataFrame, int], None],
               transform: Callable[[DataFrame], DataFrame] | None = None) -> StreamRun:
    """Stage all ranges first, then one continuous ``availableNow`` query that
    takes about ``n_batches`` micro-batches, as in production."""
    import math
    run = StreamRun(f"{root}/source", f"{root}/checkpoint")
    n_files = stage_ranges(spark, staged, key, n_batches, run.source)
    per_batch = max(1, math.ceil(n_files / n_batches))
    progress, run_id = run_available(spark, staged.schema, run.source, run.checkpoint,
                                     sink, per_batch, transform)
    run.progress.extend(progress)
    run.run_ids.append(run_id)
    return run


def _batch_folders(spark: SparkSession, path: str, stream: str, batch_id: int, depth: int) -> dict[str, set[str]]:
    """Folders of one batch of a stream below ``path`` and the files in each; ``depth``: partition
    columns above the stream."""
    above = [path]
    for _ in range(depth):
        above = [f"{p}/{name}" for p in above for name in subfolders(spark, p) if "=" in name]
    own = f"stream={stream}/batch_id={int(batch_id)}"
    return {f"{p}/{own}": files for p in above if (files := file_names(spark, f"{p}/{own}"))}


def batch_partition_write(df: DataFrame, path: str, batch_id: int,
                          sort_by: str | None = None, stream: str = "main",
                          first: tuple[str, ...] = ()) -> None:
    """Idempotent per-batch write: replaces only this batch of this stream.
    ``first``: partition columns above the stream and the batch.

    Batch ids count from 0 in every checkpoint, so streams that write to one
    table need names of their own.  A batch that is written again with fewer rows, or
    none, leaves nothing of what it wrote before."""
    from pyspark.sql import functions as F
    spark = df.sparkSession
    before = _batch_folders(spark, path, stream, batch_id, len(first))
    out = df.withColumns({"stream": F.lit(stream), "batch_id": F.lit(int(batch_id)).cast("long")})
    if sort_by:
        out = out.sortWithinPartitions(*first, "stream", "batch_id", sort_by)
    (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*first, "stream", "batch_id").parquet(path))
    for folder, files in before.items():
        if file_names(spark, folder) & files:  # no row came here this time, so it was not replaced
            remove_folder(spark, folder)


def persist_by_size(df: DataFrame) -> DataFrame:
    """``df`` kept for several uses, in as many partitions as its rows ask for: adaptive execution
    leaves kept rows in the shuffle's number of partitions, however few they are, unless told otherwise."""
    conf, key = df.sparkSession.conf, "spark.sql.optimizer.canChangeCachedPlanOutputPartitioning"
    before = conf.get(key, "false")
    conf.set(key, "true")
    try:
        return df.persist()  # the plan is fixed here
    finally:
        conf.set(key, before)


def in_batch(stream: str, batch_id: int):
    """Condition: the row was written by this batch."""
    from pyspark.sql import functions as F
    return (F.col("stream") == stream) & (F.col("batch_id") == batch_id)


def before_batch(stream: str, batch_id: int):
    """Condition: the row was not written by this batch or a later one of its stream."""
    from pyspark.sql import functions as F
    return (F.col("stream") != stream) | (F.col("batch_id") < batch_id)


def start_paced(stream: DataFrame, sink: Callable[[DataFrame, int], None],
                checkpoint: str, interval: str = "1 second"):
    """A long-running query: one micro-batch every ``interval`` (the
    reference's pacing).  Cap the batch size on the reader with
    ``maxFilesPerTrigger``.  Returns the running ``StreamingQuery``."""
    return (stream.writeStream.foreachBatch(sink)
            .option("checkpointLocation", checkpoint)
            .trigger(processingTime=interval).start())
