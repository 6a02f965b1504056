"""Lookup joins of the loader (C4, C5, C8, C9).

The reference looks up one row per stream row with a parameterised SELECT and
takes the first match, else 0.  Here the lookup side is reduced to one row per
key first (a partial aggregate: lowest id wins), then joined once with a left
outer join; a miss becomes the default.  No per-row query, no fan-out.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def first_match(lookup: DataFrame, key: str, id_col: str,
                carry: Sequence[str] = ()) -> DataFrame:
    """One row per ``key``: the lowest ``id_col`` and the columns of that row.

    ``id_col`` is unique, so ``min_by(c, id)`` takes every carried column from
    the same row; with fixed-width columns the aggregate stays a hash
    aggregate with a partial step.
    """
    return lookup.groupBy(key).agg(
        F.min(id_col).alias(id_col), *[F.min_by(c, id_col).alias(c) for c in carry])


def lookup_first(stream: DataFrame, lookup: DataFrame, key: str, id_col: str,
                 default=0, carry: Sequence[str] = ()) -> DataFrame:
    """``stream`` with ``id_col`` of the first matching lookup row, else default."""
    firsts = first_match(lookup, key, id_col, carry)
    out = stream.join(firsts, key, "left")
    if default is not None:
        out = out.withColumn(id_col, F.coalesce(F.col(id_col), F.lit(default))
                             .cast(lookup.schema[id_col].dataType))
    return out


def read_back(stored: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Stored rows whose composite key is in ``batch`` (``left_semi``)."""
    return stored.join(batch.select(*keys).distinct(), list(keys), "left_semi")
