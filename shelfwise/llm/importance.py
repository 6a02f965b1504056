"""Resampling towards a target distribution by hashed n-gram importance weights.

Features are all runs of 1 to 3 consecutive words of the lower-cased text.  A
feature falls into the bucket ``crc32(feature) % buckets``.  A bucket's gain is the
(rounded) log ratio of its share in the target and in the documents, a
document's weight is the sum of its features' gains, and documents are drawn
without replacement by adding Gumbel noise to the weights and taking the highest.

CRC-32 is linear: the checksum of a span is the XOR of one contribution per byte, which
depends on the byte and its distance from the span's end, and of a constant that
depends on the length alone.  So a table (distance, byte) is precomputed, the
contributions of all spans are gathered at once, and ``bitwise_xor.reduceat`` folds
each span.  Spans longer than the table are cut into blocks from their end; a block's
fold is carried over the bytes behind it, block by block, by the (again linear) map
of a block of zero bytes.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.surrogate import dense_key
from .common import fresh, stored

BUCKETS, GRAMS = 10_000, 3
#: Distances from the end that the table holds.
_NEAR = 64
#: Texts are hashed together until they have so many bytes.
_GROUP = 30_000
#: Lower case for A-Z; everything but letters, digits and non-ASCII bytes ends a word.
_WORDS = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32
               for c in range(256))


def _byte_table() -> np.ndarray:
    """CRC-32 state after one byte from state 0 (reflected polynomial 0xEDB88320)."""
    state = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        state = (state >> np.uint32(1)) ^ np.where(state & np.uint32(1), np.uint32(0xEDB88320), np.uint32(0))
    return state


@lru_cache(maxsize=1)
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """(contributions by distance from the end and byte, the map of ``_NEAR`` zero bytes)."""
    byte = _byte_table()
    near = np.empty((_NEAR, 256), dtype=np.uint32)
    near[0] = byte
    for d in range(1, _NEAR):
        near[d] = byte[near[d - 1] & np.uint32(255)] ^ (near[d - 1] >> np.uint32(8))
    # one more zero byte behind a state is one step; the four bytes of a state act apart
    over = np.stack([np.arange(256, dtype=np.uint32) << np.uint32(8 * k) for k in range(4)])
    for _ in range(_NEAR):
        over = byte[over & np.uint32(255)] ^ (over >> np.uint32(8))
    return near, over


def _carried(state: np.ndarray) -> np.ndarray:
    """``state`` after ``_NEAR`` zero bytes."""
    _, over = _tables()
    out = over[0][state & np.uint32(255)]
    for k in (1, 2, 3):
        out = out ^ over[k][(state >> np.uint32(8 * k)) & np.uint32(255)]
    return out


_CONSTANTS = np.empty(0, dtype=np.uint32)


def _constants(longest: int) -> np.ndarray:
    """By length: the checksum of so many zero bytes."""
    global _CONSTANTS
    if len(_CONSTANTS) <= longest:
        out, crc = [], 0
        for _ in range(max(longest + 1, 4 * _NEAR)):
            out.append(crc)
            crc = zlib.crc32(b"\0", crc)
        _CONSTANTS = np.array(out, dtype=np.uint32)
    return _CONSTANTS


def _folded(raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """XOR of the contributions of each span, none longer than the table or empty."""
    near, _ = _tables()
    n = end - start
    last = np.cumsum(n, dtype=np.int32)
    total = int(last[-1])
    step = np.arange(total, dtype=np.int32)
    place = step + np.repeat((start - (last - n)).astype(np.int32), n)
    back = np.repeat(last - np.int32(1), n) - step
    seen = near.ravel().take((back << np.int32(8)) + raw.take(place))
    return np.bitwise_xor.reduceat(seen, last - n)


def span_crc32(raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """CRC-32 of each byte span [start, end) of ``raw`` (uint8); spans are not empty."""
    n = end - start
    out = np.empty(len(n), dtype=np.uint32)
    short = n <= _NEAR
    if short.any():
        out[short] = _folded(raw, start[short], end[short])
    far = np.flatnonzero(~short)
    if len(far):
        blocks = -(-n[far] // _NEAR)
        state = np.zeros(len(far), dtype=np.uint32)
        for b in range(int(blocks.max()) - 1, -1, -1):
            here = np.flatnonzero(blocks > b)
            stop = end[far[here]] - b * _NEAR
            state[here] = _carried(state[here]) ^ _folded(
                raw, np.maximum(start[far[here]], stop - _NEAR), stop)
        out[far] = state
    return out ^ _constants(int(n.max(initial=0)))[n]


def text_buckets(texts: list[bytes | None], buckets: int = BUCKETS,
                 grams: int = GRAMS) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Group by group: (first text, texts, words by text, (text, bucket) of every feature as two rows)."""
    at = 0
    while at < len(texts):
        group, size = [], 0
        while at + len(group) < len(texts) and size <= _GROUP:
            group.append(b" ".join((texts[at + len(group)] or b"").translate(_WORDS).split()))
            size += len(group[-1])
        raw = np.frombuffer(b" ".join(g for g in group if g) + b" ", dtype=np.uint8)
        ends = np.flatnonzero(raw == 32) if size else np.empty(0, dtype=np.int64)
        starts = np.append(0, ends[:-1] + 1) if size else ends
        words = np.array([g.count(b" ") + 1 if g else 0 for g in group], dtype=np.int64)
        text = np.repeat(np.arange(len(group)), words)
        found = []
        for j in range(grams):
            i = np.flatnonzero(text[j:] == text[:len(text) - j]) if len(text) > j else text[:0]
            if len(i):
                crc = span_crc32(raw, starts[i], ends[i + j])
                found.append(np.stack([text[i], (crc % np.uint32(buckets)).astype(np.int64)]))
        yield at, len(group), words, np.concatenate(found, axis=1) if found else np.empty((2, 0), dtype=np.int64)
        at += len(group)


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS, grams: int = GRAMS) -> np.ndarray:
    """Features of all texts by bucket: each task counts its own, ``buckets`` numbers reach the driver."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for _, _, _, (_, bucket) in text_buckets(batch.column(0).to_pylist(), buckets, grams):
                total += np.bincount(bucket, minlength=buckets)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], ["bucket", "n"])

    rows = (texts.select(F.col("text").cast("binary").alias("text")).mapInArrow(count, "bucket long, n long")
            .groupBy("bucket").agg(F.sum("n").alias("n")).toPandas())
    out = np.zeros(buckets, dtype=np.int64)
    out[rows["bucket"].to_numpy(dtype=np.int64)] = rows["n"].to_numpy(dtype=np.int64)
    return out


def bucket_gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln) of a bucket's smoothed share in the target over that in the source."""
    s, t, n = source.astype(float), target.astype(float), float(len(source))
    ratio = (t + 1) * (s.sum() + n) / ((s + 1) * (t.sum() + n))
    return np.array([math.floor(1000 * math.log(r)) for r in ratio.tolist()], dtype=np.int64)


def weighted(docs: DataFrame, gains: np.ndarray, into: str = "importance", grams: int = GRAMS) -> DataFrame:
    """``docs`` with a struct column ``into``: n_words, n_features, weight (all long).

    NULL and empty texts have no words and weight 0.  Every row is weighed, repeated
    ones too; a text is hashed whole, in one task.
    """
    @F.pandas_udf("n_words long, n_features long, weight long")
    def weigh(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            parts = []
            for _, n, words, (text, bucket) in text_buckets(texts.tolist(), len(gains), grams):
                features = np.bincount(text, minlength=n)
                # sums of whole numbers: exact in integers
                sums = np.zeros(n, dtype=np.int64)
                np.add.at(sums, text, gains[bucket])
                parts.append(np.stack([words, features, sums], axis=1))
            yield pd.DataFrame(np.concatenate(parts) if parts else np.empty((0, 3), dtype=np.int64),
                               columns=["n_words", "n_features", "weight"])

    return docs.withColumn(into, weigh(F.col("text").cast("binary")))


def _noise(key, seed: int):
    """floor(1000 * Gumbel noise) drawn by hashing the key."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256), 1, 8),
               16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def scored(docs: DataFrame, target: DataFrame, seed: int = 42, buckets: int = BUCKETS, grams: int = GRAMS,
           score: str = "score", into: str = "importance") -> DataFrame:
    """``docs`` with ``into`` (n_words, n_features, weight) and ``score``, the weight with noise.

    The noise is a hash of (seed, doc_id), so reruns agree; a NULL doc_id counts as an empty one.
    An empty target gives gains towards rare buckets."""
    gains = bucket_gains(bucket_counts(docs, buckets, grams), bucket_counts(target, buckets, grams))
    return weighted(docs, gains, into, grams).withColumn(score, F.col(into)["weight"] + _noise(F.col("doc_id"), seed))


def ranked(rows: DataFrame, percent: int = 5, least_words: int = 20, rank: str = "rank", score: str = "score",
           into: str = "importance") -> DataFrame:
    """:func:`scored` rows, whichever columns are left of them, with ``rank`` (1, 2, 3, ...; NULL: not drawn).

    Of the N rows with at least ``least_words`` words the floor(percent * N / 100) with the highest
    score are drawn, ties to the smaller doc_id (NULL first).  Rows that repeat a doc_id
    rank one after another."""
    [row] = fresh(rows, "row")
    # written once: row numbers then name rows, whatever is computed again
    rows = stored(rows.withColumn(row, F.monotonically_increasing_id()), "importance_scored")
    able = rows.where(F.col(into)["n_words"] >= least_words).select(
        (-F.col(score)).alias("worse"), F.col("doc_id").alias("id"), F.col(row).alias("drawn_row"))
    drawn = dense_key(able, ["worse", "id", "drawn_row"], "place").where(
        F.col("place") <= F.lit(able.count() * percent // 100)).select("drawn_row", F.col("place").alias(rank))
    return rows.join(drawn, F.col(row) == F.col("drawn_row"), "left").drop("drawn_row", row)


def resampled(docs: DataFrame, target: DataFrame, percent: int = 5, least_words: int = 20, seed: int = 42) -> DataFrame:
    """``docs`` with importance (n_words, n_features, weight), score and rank: see :func:`scored` and
    :func:`ranked`.  Columns of ``docs`` keep their names; a new one that clashes gets another name.
    Empty ``docs`` give no rows."""
    rank, score, into = (fresh(docs, x)[0] for x in ("rank", "score", "importance"))
    return ranked(scored(docs, target, seed, score=score, into=into), percent, least_words, rank, score, into)


def resampling_weights(docs: DataFrame, target: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, n_features, weight, score, rank (see :func:`resampled`)."""
    rows = scored(docs.select("doc_id", "text"), target).drop("text")  # texts need not be written for this
    return ranked(rows).select("doc_id", "importance.n_features", "importance.weight", "score", "rank")
