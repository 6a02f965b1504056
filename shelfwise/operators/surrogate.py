"""Dense, increasing surrogate keys (the reference's AUTO_INCREMENT).

A global ``row_number()`` over an ordered window moves every row through one
task.  Instead:

1. range-partition on the order columns and sort within partitions; tag each
   row with its partition id and its position in the partition
   (``monotonically_increasing_id`` = partition id << 33 + position);
2. cut the lineage by writing the tagged rows once as a parquet table in the
   shared ``spark.checkpoint.dir`` folder, so both passes read the very same
   rows and tags, even after an executor is lost.  (``Dataset.checkpoint``
   would compute the sorted partitions twice: once to count, once to save.)
3. count rows per partition: one row per partition, a proven size bound, so
   the running offsets come from one small window and are broadcast;
4. key = offset of the partition + position in it + 1.

The range bounds are sampled on the full order key, which is unique, so a
value that repeats in a leading column (one hot day) is still split across
partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import new_scratch
from ..sources.paths import remove_folder


def dense_key(df: DataFrame, order_cols: Sequence[str], key: str,
              num_partitions: int | None = None, path: str | None = None, staged: bool = False,
              where: str | None = None, keep: Sequence[str] | None = None) -> DataFrame:
    """``df`` with the column ``key``: 1..n in the order of ``order_cols``.

    Range bounds come from a sample, for which Spark runs the plan of ``df`` once more.
    ``staged``: write ``df`` first, for plans (joins, parsing) that cost more than a write and a read;
    what is staged is deleted once the keyed rows are there.  ``where``: the rows that are wanted, chosen
    behind the staging, so that the condition is not put in front of what computes its columns.  ``keep``:
    the columns that are wanted beside the key; others only order the rows and are not written."""
    spark, columns = df.sparkSession, list(keep or df.columns)
    path = path or new_scratch(spark, "dense_key")
    if staged:
        at, schema = new_scratch(spark, "dense_key_input"), df.schema
        df.write.parquet(at)
        df = spark.read.schema(schema).parquet(at)
    df = df.where(where) if where else df
    cols = [F.col(c) for c in order_cols]
    ranged = (df.repartitionByRange(num_partitions, *cols) if num_partitions
              else df.repartitionByRange(*cols))
    pid = F.spark_partition_id()
    tagged = (ranged.sortWithinPartitions(*cols)
              .select(*columns)
              .withColumn("_pid", pid)
              .withColumn("_pos", F.monotonically_increasing_id()
                          - F.shiftleft(pid.cast("bigint"), 33)))
    tagged.write.mode("overwrite").parquet(path)
    if staged:
        remove_folder(spark, at)
    stored = spark.read.parquet(path)
    counts = stored.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select(
        "_pid",
        F.coalesce(F.sum("_n").over(
            Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)),
            F.lit(0)).alias("_off"))
    # one row per partition: bounded by the partition count, safe to broadcast
    out = stored.join(F.broadcast(offsets), "_pid")
    return out.select((F.col("_off") + F.col("_pos") + 1).alias(key),
                      *columns)
