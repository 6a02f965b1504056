"""First-wins deduplication (the reference's "seen key" sets).

The winner of a key is the row that comes first in an explicit total order,
found with a ``min`` over a struct whose leading fields are the order columns.
That is an aggregate with a map-side partial step: each map task keeps one row
per key, so a key that holds a third of the input never reaches one task as
rows.  No window, no global sort.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def first_wins(df: DataFrame, keys: Sequence[str], order_cols: Sequence[str],
               value_cols: Sequence[str], keep_order: bool = False) -> DataFrame:
    """One row per ``keys``: the values of the first row in ``order_cols`` order."""
    order_cols = [c for c in order_cols if c not in keys]
    fields = list(order_cols) + [c for c in value_cols if c not in order_cols]
    w = F.min(F.struct(*[F.col(c) for c in fields])).alias("_first")
    out_cols = [F.col(f"_first.{c}").alias(c) for c in value_cols]
    if keep_order:
        out_cols += [F.col(f"_first.{c}").alias(c) for c in order_cols
                     if c not in value_cols]
    return df.groupBy(*keys).agg(w).select(*keys, *out_cols)


def first_wins_by_id(df: DataFrame, keys: Sequence[str], id_col: str,
                     value_cols: Sequence[str]) -> DataFrame:
    """First-wins when the order is one unique integer column (a dense key):
    ``min_by`` per value, a hash aggregate with a partial step."""
    return df.groupBy(*keys).agg(*[F.min_by(c, id_col).alias(c) for c in value_cols])


def new_keys_only(candidates: DataFrame, stored: DataFrame,
                  keys: Sequence[str]) -> DataFrame:
    """Rows whose key is not yet in the stored dimension.

    Semi-join reduction: first the stored keys that this batch touches
    (stored ``left_semi`` batch keys: the batch side is small and AQE can
    broadcast it, so the stored dimension is scanned but not shuffled), then
    ``left_anti`` against that small set.  A plain ``left_anti`` could only
    broadcast the stored side and would shuffle all of it on every batch.
    """
    keys = list(keys)
    seen = stored.select(*keys).join(candidates.select(*keys), keys, "left_semi")
    return candidates.join(seen, keys, "left_anti")


def improving_rows(candidates: DataFrame, stored: DataFrame, keys: Sequence[str],
                   order_cols: Sequence[str]) -> DataFrame:
    """Candidates that are new, or come earlier in the order than every stored
    row of their key.

    Keeps a first-wins table right whatever order batches arrive in: a row is
    written only if it can still win.  The stored side is first reduced to the
    keys of the candidates (``left_semi``, the small side broadcastable), then
    an anti-join on the key with an ordinal comparison drops the beaten ones.
    """
    keys = list(keys)
    ordinal = F.struct(*[F.col(c) for c in order_cols])
    seen = (stored.select(*keys, ordinal.alias("_stored_ord"))
            .join(candidates.select(*keys), keys, "left_semi"))
    cand = candidates.withColumn("_cand_ord", ordinal)
    cond = [cand[k] == seen[k] for k in keys] + [seen["_stored_ord"] <= cand["_cand_ord"]]
    return cand.join(seen, cond, "left_anti").drop("_cand_ord")


def conflicting_attributes(df: DataFrame, key: str, attr: str) -> DataFrame:
    """Keys carrying more than one distinct value of ``attr``.

    Distinct (key, attr) pairs first (partial aggregate), then a count per key.
    """
    return (df.select(key, attr).where(F.col(attr).isNotNull()).distinct()
            .groupBy(key).agg(F.count(F.lit(1)).alias("n_values"))
            .where(F.col("n_values") > 1))
