"""The keyed buffer of stream rows (C7 / K5).

The reference keeps key -> list of stream rows.  A list per key is unbounded (one
product may carry a third of all rows), so the rows themselves are stored,
clustered by key inside each batch, each with its position in the order of
arrival: the rows of a key are a range of a sorted file, not one value.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from .runner import batch_partition_write


def buffer_rows(batch: DataFrame, path: str, batch_id: int, key: str = "product_id",
                member: str = "customer_id", position: str = "position",
                stream: str = "main") -> None:
    """Store the batch's (key, position, member) rows, sorted by key."""
    batch_partition_write(batch.select(key, position, member), path, batch_id,
                          sort_by=key, stream=stream)


def buffered(spark, path: str) -> DataFrame:
    return spark.read.parquet(path).drop("stream", "batch_id")
