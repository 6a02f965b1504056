"""Arrival and service rates of a stream (K3), kept in a stored table.

The sink notes each batch's input rows, counted before it writes, and the time
it took; a long backlog needs no memory in the driver and loses no batch.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame

from .runner import batch_partition_write

RATES = "input_rows long, seconds double, rows_per_second double"


def timed_sink(sink: Callable[[DataFrame, int], None], path: str,
               stream: str = "main") -> Callable[[DataFrame, int], None]:
    """``sink``, with one row (input_rows, seconds, rows_per_second) per batch at ``path``."""
    def run(batch: DataFrame, batch_id: int) -> None:
        rows = batch.count()  # not observed in the sink's plan: an empty batch may leave no metrics there
        began = time.perf_counter()
        sink(batch, batch_id)
        took = max(time.perf_counter() - began, 1e-9)
        batch_partition_write(batch.sparkSession.createDataFrame(
            [(rows, took, rows / took)], RATES).coalesce(1), path, batch_id, stream=stream)
    return run
