"""Token-ID files with a minimal perfect hash index for keyed access.

Format: the documents' ids lie one after another in ascending doc_id order,
cut into shard files of raw little-endian numbers (uint16 if every id fits,
else uint32).  Two tables go with them: ``entries`` (doc_id, ordinal, shard,
file, start, n) and ``index``.  The index deals keys to buckets of about
``BUCKET`` by hash; each bucket has a minimal perfect hash (cascading bit
arrays: a key sits on the first level where nobody else hashes to its bit, its
slot is the rank of that bit) and per slot a 32-bit fingerprint of the key, the
shard, the start and the number of ids.  A look-up tests a few bits and reads
one slot; a foreign key is told by its fingerprint.

Files are written and read by the tasks through ``pyarrow.fs`` in the shared
folder.  Each attempt writes files of its own, and entries name only those of
the attempts that Spark committed, so a lost executor leaves at most an orphan.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import new_scratch
from .common import map_rows, shard_bounds, shard_of, stored
from .tokenizing import encoder

ROWS_PER_SHARD, BUCKET, _LEVELS = 4096, 4096, 64
#: Fixed constants of the 64-bit murmur finaliser.
_MIX = (np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53))


def open_folder(uri: str):
    """(file system, path) of a folder given as Spark writes it."""
    from pyarrow import fs

    if uri.startswith("file:"):
        uri = "/" + uri[len("file:"):].lstrip("/")
    return (fs.LocalFileSystem(), uri) if uri.startswith("/") else fs.FileSystem.from_uri(uri)


def write_token_files(docs: DataFrame, tokenizer: str, end_id: int, folder: str) -> DataFrame:
    """Write the shard files of ``docs`` (doc_id, text); returns the entries.

    A document is the ids of its whole text (NULL: none) and ``end_id``.  NULL
    doc_ids come first; rows of one doc_id follow one another in the order of
    their ids, and ``ordinal`` counts them.
    """
    bounds = shard_bounds(docs.select("doc_id"), "doc_id", ROWS_PER_SHARD)

    def encode(batches: Iterator[list]) -> Iterator[list[tuple]]:
        enc = encoder(tokenizer)
        kind = id_type(enc.tokenizer.get_vocab_size(), end_id)
        end = np.array([end_id], kind).tobytes()
        for keys, texts in batches:
            shards = shard_of(keys, bounds).tolist()
            yield [(k, s, np.frombuffer(ids, "<u4").astype(kind).tobytes() + end)
                   for k, s, ids in zip(keys, shards, enc.ids(texts))]

    def write(batches: Iterator[list]) -> Iterator[list[tuple]]:
        files, path = open_folder(folder)
        files.create_dir(path, recursive=True)
        width = id_type(encoder(tokenizer).tokenizer.get_vocab_size(), end_id).itemsize
        shard = out = name = None
        last, ordinal, at = object(), 0, 0
        try:
            for keys, shards, payloads in batches:
                rows = []
                for key, s, ids in zip(keys, shards, payloads):
                    if s != shard:
                        if out is not None:
                            out.close()
                        name = f"shard-{s:06d}-{uuid.uuid4().hex}.ids"
                        out, shard, at, last = files.open_output_stream(f"{path}/{name}"), s, 0, object()
                    ordinal = ordinal + 1 if key == last else 0
                    last, n = key, len(ids) // width
                    out.write(ids)
                    rows.append((key, ordinal, s, name, at, n))
                    at += n
                yield rows
        finally:
            if out is not None:
                out.close()

    coded = map_rows(docs.select("doc_id", "text"), encode, "doc_id long, shard int, ids binary")
    dealt = coded.repartition("shard").sortWithinPartitions(
        "shard", F.col("doc_id").asc_nulls_first(), "ids")
    return stored(map_rows(dealt, write, "doc_id long, ordinal int, shard int, file string, "
                           "start long, n long"), "token_entries")


def id_type(vocabulary: int, end_id: int) -> np.dtype:
    return np.dtype("<u2" if max(vocabulary - 1, end_id) < 1 << 16 else "<u4")


def _spread(h1: np.ndarray, h2: np.ndarray, level: int, size: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        z = h1 ^ ((h2 + np.uint64(level)) * _MIX[0])
        z = (z ^ (z >> np.uint64(33))) * _MIX[1]
        return ((z ^ (z >> np.uint64(33))) % np.uint64(size)).astype(np.int64)


def build_hash(h1: np.ndarray, h2: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """(bit arrays by level, slot of each key) for distinct 128-bit key hashes."""
    left, levels, slots, base = np.arange(len(h1)), [], np.zeros(len(h1), np.int64), 0
    while len(left):
        if len(levels) == _LEVELS:
            raise ValueError("two keys have the same 128-bit hash")
        size = 2 * len(left) + 1
        at = _spread(h1[left], h2[left], len(levels), size)
        bits = np.bincount(at, minlength=size) == 1
        hit = bits[at]
        slots[left[hit]] = base + np.cumsum(bits)[at[hit]] - 1
        levels.append(bits)
        base, left = base + int(bits.sum()), left[~hit]
    return levels, slots


def look_up(levels: list[np.ndarray], h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
    """Slots of keys, -1 where no level has the key's bit."""
    slots, left, base = np.full(len(h1), -1, np.int64), np.arange(len(h1)), 0
    for k, bits in enumerate(levels):
        at = _spread(h1[left], h2[left], k, len(bits))
        hit = bits[at]
        slots[left[hit]] = base + np.cumsum(bits)[at[hit]] - 1
        base, left = base + int(bits.sum()), left[~hit]
    return slots


def _keyed(keys: DataFrame, buckets: int) -> DataFrame:
    parts = (F.coalesce("doc_id", F.lit(0)), F.col("doc_id").isNull(), "ordinal")
    return keys.withColumns({"h1": F.xxhash64(*parts), "h2": F.xxhash64(F.lit("second"), *parts)}
                            ).withColumn("bucket", F.pmod("h1", F.lit(buckets)))


def build_index(entries: DataFrame) -> tuple[DataFrame, int]:
    """(index, number of buckets): one row per bucket, see the module's docstring."""
    buckets = max(1, -(-entries.count() // BUCKET))

    def build(b: pd.DataFrame) -> pd.DataFrame:
        h1, h2 = (b[c].to_numpy().view(np.uint64) for c in ("h1", "h2"))
        levels, slots = build_hash(h1, h2)
        at = np.argsort(slots)
        return pd.DataFrame([(int(b["bucket"].iloc[0]), [len(x) for x in levels],
                              np.packbits(np.concatenate(levels)).tobytes(),
                              (h2[at] & np.uint64(0xFFFFFFFF)).astype("<u4").tobytes(),
                              b["shard"].to_numpy()[at].astype("<i4").tobytes(),
                              b["start"].to_numpy()[at].astype("<i8").tobytes(),
                              b["n"].to_numpy()[at].astype("<i8").tobytes())])

    index = (_keyed(entries, buckets).select("bucket", "h1", "h2", "shard", "start", "n")
             .groupBy("bucket").applyInPandas(build, "bucket long, sizes array<long>, bits binary, "
                                              "fingerprints binary, shards binary, starts binary, counts binary"))
    return stored(index, "token_index"), buckets


def locate(keys: DataFrame, index: DataFrame, buckets: int) -> DataFrame:
    """``keys`` (doc_id, ordinal) with shard, start and n from the index; unknown keys: shard -1."""
    def find(_, queries: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        out = queries[["h1", "h2"]].assign(shard=-1, start=-1, n=-1)
        if len(found) and len(out):
            row = found.iloc[0]
            cut = np.cumsum([0, *row["sizes"]])
            bits = np.unpackbits(np.frombuffer(row["bits"], np.uint8)).astype(bool)
            levels = [bits[a:b] for a, b in zip(cut, cut[1:])]
            h1, h2 = (queries[c].to_numpy().view(np.uint64) for c in ("h1", "h2"))
            slot = look_up(levels, h1, h2)
            marks = np.frombuffer(row["fingerprints"], "<u4")
            ok = (slot >= 0) & (marks[slot] == (h2 & np.uint64(0xFFFFFFFF)).astype("<u4"))
            for name, column, kind in (("shard", "shards", "<i4"), ("start", "starts", "<i8"),
                                       ("n", "counts", "<i8")):
                out[name] = np.where(ok, np.frombuffer(row[column], kind)[slot], -1)
        # ids as two halves stay exact beside NULLs
        return out.assign(doc_id=queries["doc_key"], missing=queries["missing"])

    asked = _keyed(keys, buckets).select(
        "bucket", "h1", "h2", F.coalesce("doc_id", F.lit(0)).alias("doc_key"),
        F.col("doc_id").isNull().alias("missing"))
    got = asked.groupBy("bucket").cogroup(index.groupBy("bucket")).applyInPandas(
        find, "h1 long, h2 long, shard long, start long, n long, doc_id long, missing boolean")
    return got.select(F.when(~F.col("missing"), F.col("doc_id")).alias("doc_id"), "shard", "start", "n")


def read_back(located: DataFrame, shards: list[tuple[str, int]], folder: str, width: int) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 read from the files at the located places.

    ``shards``: file and first global position of every shard number.  A row that was not
    found (shard -1) is an error: leave keys out that may be unknown.
    """
    def read(batches: Iterator[list]) -> Iterator[list[tuple]]:
        files, path = open_folder(folder)
        shard = source = None
        try:
            for ids, numbers, starts, counts in batches:
                rows = []
                for doc, s, start, n in zip(ids, numbers, starts, counts):
                    if s < 0:
                        raise KeyError(f"document {doc} is not in the index")
                    if s != shard:
                        if source is not None:
                            source.close()
                        source, shard = files.open_input_file(f"{path}/{shards[s][0]}"), s
                    raw = source.read_at(n * width, start * width)
                    raw = np.frombuffer(raw, f"<u{width}").astype("<u4").tobytes()
                    rows.append((doc, shards[s][1] + start, len(raw) // 4, zlib.crc32(raw)))
                yield rows
        finally:
            if source is not None:
                source.close()

    dealt = (located.repartition("shard").sortWithinPartitions("shard", "start")
             .select("doc_id", "shard", "start", "n"))
    return map_rows(dealt, read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_files_round_trip(docs: DataFrame, tokenizer: str, end_id: int = 2) -> DataFrame:
    """Write, index, look up every document by key, and read it back from the files.

    Every row is written and read, repeated ones and those without an id too; a NULL text is empty and
    holds the end alone.  A text is encoded and read whole, in memory that grows with it."""
    folder = new_scratch(docs.sparkSession, "token_files")
    entries = write_token_files(docs, tokenizer, end_id, folder)
    index, buckets = build_index(entries)
    # one row per shard: MAX_SHARDS at most, and one more for each range partition of the bounds
    rows = entries.groupBy("shard", "file").agg(F.sum("n").alias("n")).collect()
    shards, at = [("", 0)] * (1 + max((r.shard for r in rows), default=-1)), 0
    for r in sorted(rows, key=lambda r: r.shard):
        shards[r.shard], at = (r.file, at), at + r.n
    width = id_type(encoder(tokenizer).tokenizer.get_vocab_size(), end_id).itemsize
    return read_back(locate(entries.select("doc_id", "ordinal"), index, buckets), shards, folder, width)
