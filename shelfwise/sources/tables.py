"""The driver's parquet tables, read lazily.

Each table is a plain ``spark.read.parquet``; the star views select only the
columns they use, so every scan's ReadSchema is pruned and filters reach the
parquet reader.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from .paths import file_states

TABLE_NAMES = ("region", "nation", "customer", "supplier", "part", "orders",
               "lineitem", "events")


@dataclass
class Tables:
    spark: SparkSession
    sf_dir: str
    _cache: dict = field(default_factory=dict)

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in TABLE_NAMES:
            raise AttributeError(name)
        if name not in self._cache:
            self._cache[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._cache[name]

    def states(self, *names: str) -> list[tuple[str, int, int]]:
        """Files of these tables as they lie there now (see ``paths.file_states``)."""
        return [f for name in names for f in file_states(self.spark, f"{self.sf_dir}/{name}.parquet")]


def load_tables(spark: SparkSession, sf_dir: str) -> Tables:
    return Tables(spark, sf_dir.rstrip("/"))
