"""Small helpers shared by the operators: reading, storing, sharding by key order."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import new_scratch

#: Words are maximal runs of anything but ASCII space and \t \n \v \f \r.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"

#: A shard table is looked up from every task, so its length is bounded.
MAX_SHARDS = 65_536


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """Write ``df`` once to the shared scratch folder and read it back.

    This cuts the lineage: what was computed survives a lost executor and is
    not computed again by each consumer.
    """
    path = new_scratch(df.sparkSession, name)
    df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Names for helper columns that no column of ``df`` has, whatever its case."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def row_hash(*cols: str):
    """Tells rows of one doc_id apart; rows equal in all ``cols`` are repeats."""
    return F.xxhash64(*[x for c in cols for x in (F.col(c), F.col(c).isNull())])


def shard_bounds(ids: DataFrame, key: str, rows_per_shard: int) -> list[int | None]:
    """The smallest key of each shard when ``key`` is cut into ranges of rows.

    Only the key column is shuffled: each task sorts a range of keys and names
    every ``rows_per_shard``-th one.  There are about ``MAX_SHARDS`` bounds at
    most, the shards being larger beyond that.  NULL keys sort first, so only the
    first bound may be None.
    """
    n = ids.count()
    step = max(rows_per_shard, -(-n // MAX_SHARDS))
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    ascending = F.col(key).asc_nulls_first()
    rows = (ids.select(key).repartitionByRange(ascending).sortWithinPartitions(ascending)
            .withColumn("_place", place).where(F.col("_place") % step == 0).select(key).collect())
    found = {r[0] for r in rows}
    return [None] * (None in found) + sorted(found - {None})


def shard_of(keys: Iterable, bounds: list[int | None]) -> np.ndarray:
    """Number of the shard that holds each key (NULL: the first shard)."""
    offset = 1 if bounds and bounds[0] is None else 0
    known = np.array(bounds[offset:], dtype=np.int64)
    keys = list(keys)
    given = np.array([0 if k is None else k for k in keys], dtype=np.int64)
    place = np.maximum(0, np.searchsorted(known, given, "right") - 1 + offset)
    return np.where(np.array([k is None for k in keys], dtype=bool), 0, place).astype(np.int32)


_ARROW = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string(),
          "binary": pa.binary(), "boolean": pa.bool_(), "array<int>": pa.list_(pa.int32()),
          "array<long>": pa.list_(pa.int64())}


def map_rows(df: DataFrame, rows: Callable[[Iterator[list]], Iterator[list[tuple]]], fields: str) -> DataFrame:
    """``mapInArrow`` with plain Python values, so that NULL and 64-bit ids stay exact.

    ``rows`` gets the columns of one batch after another, as lists, and yields
    lists of output tuples.  ``fields``: "name type, ..." of the output.
    """
    schema = pa.schema([(n, _ARROW[t]) for n, t in (f.split() for f in fields.split(", "))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for out in rows([c.to_pylist() for c in b.columns] for b in batches):
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    return df.mapInArrow(run, fields)


def uniform(*cols):
    """A number in [0, 1) drawn by hashing ``cols``: reruns draw the same."""
    return F.xxhash64(*cols).bitwiseAND(F.lit((1 << 53) - 1)) / F.lit(float(1 << 53))


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per Spark application."""
    import os
    import tempfile
    import zipfile

    sc = spark.sparkContext
    if getattr(sc, "_shelfwise_shipped", False):
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="shelfwise-py-"), "shelfwise_package.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.join("shelfwise", os.path.relpath(full, root)))
    sc.addPyFile(path)  # Spark's file server hands it to every executor
    sc._shelfwise_shipped = True
