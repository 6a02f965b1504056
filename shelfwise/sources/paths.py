"""Existence checks on the shared file system (HDFS, S3, local), through
Hadoop's FileSystem API, so that reading a table that may not exist yet does
not go through a failing Spark query."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(p))


def holds_data(spark: SparkSession, path: str) -> bool:
    """True if the folder holds more than markers: a write of no rows by partition
    leaves only those, and no schema to read."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return any(s.getPath().getName()[:1] not in ("_", ".") for s in fs.listStatus(p))


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders right below ``path``; none if there is no such folder."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return []
    return [s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()]


def file_names(spark: SparkSession, path: str) -> set[str]:
    """Names of the files right below ``path``; none if there is no such folder."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return set()
    return {s.getPath().getName() for s in fs.listStatus(p) if s.isFile()}


def file_states(spark: SparkSession, path: str) -> list[tuple[str, int, int]]:
    """Path, length and time of change of every file at or below ``path``: equal as long as nothing is written there."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    found = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listFiles(p, True)
    out = []
    while found.hasNext():
        f = found.next()
        out.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    return sorted(out)


def folder_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of all files below ``path``."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getContentSummary(p).getLength()


def holds_batches(spark: SparkSession, path: str) -> bool:
    """True if a table laid out in folders by partition has any."""
    return any("=" in name for name in subfolders(spark, path))


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder that the library has written and no reader needs any more."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def read_parquet_if_exists(spark: SparkSession, path: str) -> DataFrame | None:
    return spark.read.parquet(path) if exists(spark, path) and holds_data(spark, path) else None
