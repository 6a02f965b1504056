"""Document fingerprints: a homomorphic multiset hash over paragraphs.

A text is the multiset of its paragraphs (lines, cut at sentence ends and
every ``MOST_WORDS`` words).  Each paragraph is hashed to a wide vector and the
vectors are summed: ``EXACT`` lanes of uniform numbers modulo 2**64 for
equality, and ``LIKE`` lanes modulo 2**32 for likeness, a sketch of signed counts
of the paragraphs' overlapping windows of ``WINDOW`` bytes.  Sums do not depend on
order, and a paragraph is inserted or deleted by adding or subtracting its vector,
without the rest of the text.  A lane cannot wrap in a text under 2**31 bytes.  A
fingerprint is the lanes themselves, as bytes or hex digits, so that it can be edited and
compared later.

A window falls into one lane with one sign, so the inner product of two likeness
vectors estimates the windows they share: ``2 a.b / (a.a + b.b)`` is 1 for equal
texts and near 0 for unrelated ones.  Lanes count up to ``MOST_PULL`` times their
median size only, so that one often repeated paragraph does not outweigh the rest.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_rows, shard_bounds, shard_of

EXACT, LIKE, MOST_WORDS = 4, 256, 24
#: About three words; and lanes' bound in medians of their sizes.
WINDOW, MOST_PULL = 16, 2.0
#: Before each paragraph, so that its first bytes have windows too; not a byte of UTF-8.
_PAD = b"\xff" * (WINDOW - 1)
_BLOCK = 2048
#: Fixed constants of the splitmix64 finaliser.
_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))
_CUT = re.compile(r"\n|(?<=[.!?]) ")


def paragraphs(text: str) -> list[str]:
    """The pieces of a text that are hashed, in order; pieces without a word count too."""
    out = []
    for piece in _CUT.split(text):
        words = piece.split(" ")
        if len(words) <= MOST_WORDS:
            out.append(piece)
        else:
            out += [" ".join(words[k:k + MOST_WORDS]) for k in range(0, len(words), MOST_WORDS)]
    return out


def _mixed(z: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        z = (z ^ (z >> np.uint64(30))) * _MIX[1]
        z = (z ^ (z >> np.uint64(27))) * _MIX[2]
        return z ^ (z >> np.uint64(31))


def _vectors(seeds: np.ndarray) -> np.ndarray:
    """(paragraphs, EXACT) uniform 64-bit numbers from the paragraphs' hashes."""
    with np.errstate(over="ignore"):
        return _mixed(seeds[:, None] + _MIX[0] * np.arange(1, EXACT + 1, dtype=np.uint64))


def _windows(raw: list[bytes]) -> np.ndarray:
    """Hashes of the windows that end at each byte, or the end, of each paragraph."""
    joined = b"".join(_PAD + r + b"\n" for r in raw)
    eights = np.empty(len(joined) - 7, dtype=np.uint64)
    for k in range(8):
        part = eights[k::8]
        part[:] = np.frombuffer(joined, "<u8", len(part), k)
    inside = np.frombuffer(joined, np.uint8)[WINDOW - 1:] != 0xFF
    first, last = eights[:-8][inside], eights[8:][inside]
    with np.errstate(over="ignore"):
        return _mixed(_mixed(first + _MIX[0]) + last)


def multiset_hash(pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(exact, like) lanes of a multiset of paragraphs; both add up over multisets."""
    import xxhash

    exact, like = np.zeros(EXACT, np.uint64), np.zeros(LIKE, np.int64)
    for k in range(0, len(pieces), _BLOCK):
        part = pieces[k:k + _BLOCK]
        raw = [p.encode("utf-8", "replace") for p in part]
        z = _vectors(np.array([xxhash.xxh3_64_intdigest(r) for r in raw], dtype=np.uint64))
        with np.errstate(over="ignore"):
            exact += z.sum(axis=0, dtype=np.uint64)
        w = _windows(raw)
        sign = (w & np.uint64(1)).astype(np.float64) * 2 - 1
        like += np.bincount((w >> np.uint64(64 - LIKE.bit_length() + 1)).astype(np.int64), sign, LIKE).astype(np.int64)
    return exact, like.astype(np.uint32)


def add(a: tuple, b: tuple, sign: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """Hash of the union of two multisets, or of their difference with ``sign=-1``."""
    with np.errstate(over="ignore"):
        return tuple(x + y if sign > 0 else x - y for x, y in zip(a, b))


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """0 to 1 from two likeness vectors; two empty ones are equal."""
    x, y = (v.astype(np.int32).astype(np.float64) for v in (a, b))
    sizes = np.abs(np.concatenate([x, y]))
    if not sizes.any():
        return 1.0
    most = MOST_PULL * np.median(sizes[sizes > 0])
    x, y = np.clip(x, -most, most), np.clip(y, -most, most)
    return float(np.clip(2 * (x @ y) / (x @ x + y @ y), 0, 1))


def to_bytes(h: tuple) -> bytes:
    return h[0].astype("<u8").tobytes() + h[1].astype("<u4").tobytes()


def from_bytes(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    return (np.frombuffer(raw, "<u8", EXACT).astype(np.uint64),
            np.frombuffer(raw, "<u4", LIKE, 8 * EXACT).astype(np.uint32))


def replaced(h: tuple, before: list[str], after: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The hash of the paragraphs ``after`` from ``h``, that of ``before``: what differs behind
    their common beginning is deleted and inserted."""
    k = next((k for k, (x, y) in enumerate(zip(before, after)) if x != y), min(len(before), len(after)))
    return add(add(h, multiset_hash(before[k:]), -1), multiset_hash(after[k:]))


def fingerprint_column(text):
    """Binary column: the lanes of whole texts (NULL: empty), EXACT then LIKE."""
    @F.pandas_udf("binary")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([to_bytes(multiset_hash(paragraphs(t or ""))) for t in texts])
    return of(text)


def edited(text: str, after: str) -> str:
    """``text`` with its last quarter replaced by as much of the beginning of ``after``."""
    k = len(text) // 4
    return text[:len(text) - k] + after[:k]


def with_next(docs: DataFrame, prepare, per_row, fields: str, rows_per_shard: int = 128) -> DataFrame:
    """Run ``per_row(doc_id, own, next)`` over all rows in ascending doc_id order.

    ``own`` and ``next`` are what ``prepare(text)`` has made of the row's text and of its
    successor's, once for each row.  Rows are dealt to ranges of doc_id; the first row of each
    range also goes to the range before it (the very first one to the last), so a task sees
    every row's successor without a window over the table.  NULL doc_ids come first;
    rows of equal doc_id are ordered by text.  Only one row is held at a time.
    """
    ids = docs.select("doc_id")
    bounds = shard_bounds(ids, "doc_id", rows_per_shard)
    if not bounds:
        bounds = [0]
    n = len(bounds)
    firsts = {b: k for k, b in enumerate(bounds)}

    @F.arrow_udf("array<bigint>")
    def route(keys: pa.Array) -> pa.Array:
        keys = keys.to_pylist()
        return pa.array([[2 * int(s)] + ([2 * ((firsts[k] - 1) % n) + 1] if k in firsts else [])
                         for k, s in zip(keys, shard_of(keys, bounds))], pa.list_(pa.int64()))

    def walk(batches: Iterator[list]) -> Iterator[list[tuple]]:
        held = None  # (shard, doc_id, own): waits for its successor
        for codes, docs, texts in batches:
            out = []
            for code, doc, text in zip(codes, docs, texts):
                own = prepare(text or "")
                if held is not None and held[0] == code >> 1:
                    out.append(per_row(held[1], held[2], own))
                held = None if code & 1 else (code >> 1, doc, own)
            yield out

    dealt = (docs.select("doc_id", "text").withColumn("code", F.explode(route("doc_id")))
             .withColumn("shard", F.shiftright("code", 1)).repartition("shard")
             .sortWithinPartitions("shard", "code", F.col("doc_id").asc_nulls_first(),
                                   F.col("text").asc_nulls_first()))
    return map_rows(dealt.select("code", "doc_id", "text"), walk, fields)


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """Per row: fingerprints of the text and of its edited text, and likenesses.

    doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint (hex digits of the
    lanes), near_edited, near_next.  A text is hashed once, for itself and as the next one of
    the row before; the edited text's hash comes from it by deleting and inserting the
    paragraphs that differ.  NULL texts are empty; rows that repeat a doc_id are
    ordered by text and each is the next one of the row before it; they lie in one shard, which
    one task walks.  Time and memory of a row grow with its text and the next one's.
    """
    def prepare(text: str) -> tuple:
        pieces = paragraphs(text)
        return text, pieces, multiset_hash(pieces)

    def per_row(doc, own, following):
        (text, pieces, h), (after, _, next_h) = own, following
        new = edited(text, after)
        other = replaced(h, pieces, paragraphs(new))
        return (doc, len(text), hashlib.sha256(new.encode("utf-8", "replace")).hexdigest(), to_bytes(h).hex(),
                to_bytes(other).hex(), likeness(h[1], other[1]), likeness(h[1], next_h[1]))

    return with_next(docs, prepare, per_row, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
                     "edited_fingerprint string, near_edited double, near_next double")
