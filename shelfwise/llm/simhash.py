"""SimHash near-dedup: tiled exact comparison of 64-bit fingerprints.

1. A fingerprint per text (Python inside Arrow batches; words, shingles and
   XXH64 as documented at :func:`fingerprint`).
2. Equal fingerprints fold to one row (map-side), so a group of exact copies of
   any size costs one row from here on.
3. Tiles: distinct fingerprints are laid out by the population counts of their
   four 16-bit quarters, and a large cell is cut by hash into tiles of about
   ``TILE`` rows.  Two fingerprints within ``radius`` bits have population
   counts within ``radius`` (summed over the quarters), so all other tile pairs
   are skipped and no link is lost.  There are at most 17**4 cells.
4. Each remaining pair of tiles is compared exactly: numpy XOR and bit counts,
   block by block.  A tile pair returns a spanning forest of the links it has
   found, fewer rows than fingerprints however many links there are.
5. Components by large-star / small-star on those edges, each round written to
   the shared scratch folder.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fresh, stored

TILE = 4096
QUARTERS = 4
_BLOCK = 256
_SIDE = 17  # a quarter of 16 bits has 0..16 ones
_CHUNK = 1 << 15


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """64-bit SimHash of a whole text, as an unsigned number.

    Lower-cases A-Z, takes runs of anything but ASCII white space as words and
    hashes every run of ``shingle`` words (repeats included; a text with fewer
    words is one shingle) with XXH64, seed 42.  A bit is set if it is set in
    more than half of the hashes.  No words, or NULL: 0.
    """
    import xxhash

    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    take = min(shingle, len(words))
    first, last = starts[:len(words) - take + 1].tolist(), ends[take - 1:].tolist()
    digest, ones = xxhash.xxh64_intdigest, np.zeros(64, dtype=np.int64)
    for k in range(0, len(first), _CHUNK):
        h = np.array([digest(joined[a:b], 42)
                      for a, b in zip(first[k:k + _CHUNK], last[k:k + _CHUNK])], dtype="<u8")
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(first), bitorder="little").view("<u8")[0])


def fingerprints(texts, shingle: int = 3):
    """Column of fingerprints, as Spark's signed 64-bit numbers."""
    @F.pandas_udf("long")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(np.array([fingerprint(t, shingle) for t in texts],
                                     dtype=np.uint64).view(np.int64))
    return of(texts)


def _cell_offsets(radius: int) -> list[tuple[int, ...]]:
    """Quarter-wise differences of population counts that ``radius`` allows, one of each pair."""
    span = range(-radius, radius + 1)
    zero = (0,) * QUARTERS
    return [d for d in product(span, repeat=QUARTERS) if sum(map(abs, d)) <= radius and d >= zero]


def _fold(labels: np.ndarray, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Join the groups in ``labels`` that the links (u, v) connect."""
    while True:
        low = np.minimum(labels[u], labels[v])
        if (labels[u] == low).all() and (labels[v] == low).all():
            return labels
        np.minimum.at(labels, labels[u], low)
        np.minimum.at(labels, labels[v], low)
        while True:
            up = labels[labels]
            if (up == labels).all():
                break
            labels = up


def link_tiles(a: np.ndarray, b: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links between two tiles of fingerprints (uint64)."""
    both, labels = np.concatenate([a, b]), np.arange(len(a) + len(b))
    for k in range(0, len(a), _BLOCK):
        far = np.bitwise_count(a[k:k + _BLOCK, None] ^ b[None, :])
        u, v = np.nonzero(far <= radius)
        if len(u):
            labels = _fold(labels, u + k, v + len(a))
    tied = np.flatnonzero(labels != np.arange(len(labels)))
    src, dst = both[tied], both[labels[tied]]
    return src[src != dst], dst[src != dst]


def _compare(radius: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = batch.column(0), batch.column(1)
            out = []
            for i in range(batch.num_rows):
                x = a[i].values.to_numpy(zero_copy_only=False).view(np.uint64)
                y = b[i].values.to_numpy(zero_copy_only=False).view(np.uint64)
                u, v = link_tiles(x, y, radius)
                if len(u):
                    out.append((u, v))
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(side).view(np.int64)) for side in zip(*out)],
                    names=["u", "v"])
    return run


def links(nodes: DataFrame, radius: int = 2) -> DataFrame:
    """Edges (u, v) that connect all distinct fingerprints ``fp`` within ``radius`` bits."""
    counts = [F.bit_count(F.shiftrightunsigned("fp", 16 * k).bitwiseAND(F.lit(0xFFFF)))
              for k in range(QUARTERS)]
    laid = nodes.select("fp", *[c.alias(f"q{k}") for k, c in enumerate(counts)])
    cell = [f"q{k}" for k in range(QUARTERS)]
    per_cell = (laid.groupBy(*cell).agg(F.count(F.lit(1)).alias("n"))
                .select(*cell, F.ceil(F.col("n") / TILE).alias("tiles")))
    # one row per cell, at most 17**4 of them
    tiles = stored(laid.join(F.broadcast(per_cell), cell)
                   .withColumn("tile", F.pmod(F.xxhash64("fp"), F.col("tiles")))
                   .groupBy(*cell, "tile").agg(F.collect_list("fp").alias("fps")), "simhash_tiles")
    near = F.array(*[F.struct(*[(F.col(f"q{k}") + d[k]).alias(f"q{k}") for k in range(QUARTERS)],
                              F.lit(not any(d)).alias("same")) for d in _cell_offsets(radius)])
    left = (tiles.withColumn("to", F.explode(near))
            .select("to.*", F.col("tile").alias("a_tile"), F.col("fps").alias("a"))
            .where(F.greatest(*cell) < _SIDE).where(F.least(*cell) >= 0))
    right = tiles.select(*cell, F.col("tile").alias("b_tile"), F.col("fps").alias("b"))
    pairs = (left.join(right, cell).where(~F.col("same") | (F.col("a_tile") <= F.col("b_tile")))
             .select("a", "b"))
    return pairs.mapInArrow(_compare(radius), "u long, v long")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges``: root is the smallest node reachable.

    Alternates large-star and small-star until the edges stand still.
    """
    now = stored(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                 .where("u != v").distinct(), "components")
    seen = None
    while True:
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least("u", F.min("v")).alias("low"))
        large = (both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("low").alias("v"))
                 .distinct())
        low = large.groupBy("u").agg(F.min("v").alias("low"))
        small = (large.join(low, "u")
                 .select(F.explode(F.array(F.struct("u", F.col("low").alias("v")),
                                           F.struct(F.col("v").alias("u"), F.col("low").alias("v")))).alias("e"))
                 .select("e.*").where("u != v").distinct())
        now = stored(small, "components")
        mark = now.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if tuple(mark) == seen:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
                now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        seen = tuple(mark)


def near_components(signatures: DataFrame, key: str, radius: int = 2) -> DataFrame:
    """(fp, least): for every distinct fingerprint the smallest ``key`` of its component."""
    nodes = stored(signatures.groupBy("fp").agg(F.min(key).alias("own")), "simhash_nodes")
    member = stored(components(links(nodes, radius)), "simhash_members")
    least = (member.join(nodes, member.node == nodes.fp)
             .groupBy("root").agg(F.min("own").alias("of_root")))
    placed = member.join(least, "root").select(F.col("node").alias("fp"), "of_root")
    # stored, so that a join with the rows has two plain sides and a hot fingerprint can be split
    return stored(nodes.join(placed, "fp", "left").select("fp", F.coalesce("of_root", "own").alias("least")),
                  "simhash_least")


def simhash_components(docs: DataFrame, shingle: int = 3, radius: int = 2) -> DataFrame:
    """One row per row of ``docs``: doc_id, fp (signed), fingerprint (hex), component_id.

    Fingerprints that differ in ``radius`` bits or fewer are linked, and
    component_id is the smallest doc_id that links reach.  NULL and empty texts
    have fingerprint 0, linked like any other; NULL doc_ids never become a
    component_id unless a component has no other.  Repeated rows all come back.
    Other columns of ``docs`` are not looked at.
    """
    sig = stored(docs.select("doc_id", fingerprints(F.col("text"), shingle).alias("fp")),
                 "simhash_signatures")
    least = near_components(sig, "doc_id", radius)
    return sig.join(least, "fp").select(
        "doc_id", "fp", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        F.col("least").alias("component_id"))


def near_dedup(docs: DataFrame, shingle: int = 3, radius: int = 2) -> DataFrame:
    """``docs`` with one row left of each component, all columns kept.

    The row with the smallest doc_id stays (NULL doc_ids last, then the smaller
    hash of the text); of repeated rows one stays.
    """
    key = fresh(docs, "_id", "_null", "_hash")
    keyed = docs.withColumns(dict(zip(key, (F.coalesce("doc_id", F.lit(0)), F.col("doc_id").isNull(),
                                            F.xxhash64("text")))))
    pick = F.struct(F.col(key[1]).alias("missing"), F.col(key[0]).alias("id"), F.col(key[2]).alias("hash"))
    sig = stored(keyed.select(pick.alias("pick"), fingerprints(F.col("text"), shingle).alias("fp")),
                 "simhash_signatures")
    keep = (near_components(sig, "pick", radius).select("least").distinct()
            .select(*[F.col(f"least.{c}").alias(k) for c, k in zip(("id", "missing", "hash"), key)]))
    # one shuffle of the texts serves the join and the removal of repeated rows
    return keyed.join(keep, key, "left_semi").dropDuplicates(key).select(*docs.columns)
