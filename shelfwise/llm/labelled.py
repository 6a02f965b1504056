"""Bounded samples of labelled texts for fitting small models on the driver."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def labelled_sample(docs: DataFrame, labels: DataFrame, rows: int, keep: Column | None = None) -> DataFrame:
    """At most ``rows`` labelled texts (doc_id, text, label), chosen by hash of the doc_id.

    ``keep`` filters the labels first (a fold).  NULL qualities and NULL ids are
    not labels; of contradicting labels of one doc_id the higher one holds.
    ``rows`` bounds the ids; rows that repeat an id all come back, see
    :func:`one_row_each`.
    """
    wanted = labels.where("quality IS NOT NULL AND doc_id IS NOT NULL")
    if keep is not None:
        wanted = wanted.where(keep)
    chosen = (wanted.groupBy("doc_id").agg(F.max("quality").cast("int").alias("label"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows))
    # ``rows`` bounds what is broadcast
    return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")


def one_row_each(measured: DataFrame) -> DataFrame:
    """The least row of each doc_id, so that repeated ids do not exceed the bound of a sample.

    Called on what was measured, not on the texts, and reduced map-side first.
    """
    rest = [c for c in measured.columns if c != "doc_id"]
    return (measured.groupBy("doc_id").agg(F.min(F.struct(*rest)).alias("least"))
            .select("doc_id", "least.*"))
