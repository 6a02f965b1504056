"""Best-fit packing with the Martello-Toth dominance reduction.

Pieces of equal length are interchangeable, so the plan is made on their
histogram: at most ``capacity`` lengths, whatever the number of documents.

1. Reduction: small sets of pieces that provably dominate every other filling
   are fixed as sequences for good (a piece that nothing fits beside, an exact
   pair, the best partner where only one more fits, the best pair where two
   more fit), in bulk, until no rule applies.
2. The rest by best fit, longest first; equal lengths are placed together.

The plan is a list of runs (next pieces of a length -> sequences).  Pieces are
numbered by (length, doc_id, piece) with distributed dense keys, and each task
finds its pieces' runs by binary search.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.surrogate import dense_key
from .common import map_rows, stored
from .tokenizing import encoder

CAPACITY = 4096


class Plan:
    """Runs of pieces: the ``count`` next ones of a length go to sequences
    first_sequence, first_sequence + 1, ..., ``each`` of them side by side from ``offset`` on."""

    def __init__(self):
        self.runs: dict[int, list[tuple]] = {}
        self.sequences = 0

    def open(self, count: int) -> int:
        first, self.sequences = self.sequences, self.sequences + count
        return first

    def put(self, length: int, count: int, each: int, sequence: int, offset: int) -> None:
        self.runs.setdefault(length, []).append((count, each, sequence, offset))


def reduce_dominated(counts: np.ndarray, capacity: int, plan: Plan) -> None:
    """Fix dominating sets of one to three pieces; ``counts`` keeps the rest.

    For the piece j the rules are those of Martello and Toth: j alone if nothing
    fits beside it; j with its largest partner if they fill the sequence, if no
    two pieces fit beside j, or if two at most do and that partner is as long as
    the best two together; j with its largest partner a and the largest b beside
    them if at most two fit and no two pieces longer than b fit beside j.
    Removing pieces never breaks a rule, so equal pieces are fixed together.
    """
    changed = True
    while changed:
        changed = False
        for j in np.flatnonzero(counts)[::-1].tolist():
            while counts[j]:
                found = _dominating(counts, capacity, j)
                if found is None:
                    break
                parts = [j, *found]
                times = min(int(counts[p]) // parts.count(p) for p in parts)
                first, offset = plan.open(times), 0
                for p in parts:
                    plan.put(p, times, 1, first, offset)
                    counts[p] -= times
                    offset += p
                changed = True


def _dominating(counts: np.ndarray, capacity: int, j: int) -> list[int] | None:
    counts[j] -= 1
    try:
        lengths = np.flatnonzero(counts)
        room = capacity - j
        if not len(lengths) or lengths[0] > room:
            return []
        a = int(lengths[np.searchsorted(lengths, room, "right") - 1])

        def smallest(above: int, n: int) -> int | None:
            """Sum of the n smallest pieces longer than ``above``."""
            total = 0
            for x in lengths[np.searchsorted(lengths, above, "right"):].tolist():
                take = min(n, int(counts[x]))
                total, n = total + take * x, n - take
                if not n:
                    return total
            return None

        two = smallest(0, 2)
        if a == room or two is None or two > room:
            return [a]
        three = smallest(0, 3)
        if three is not None and three <= room:
            return None
        best = 0  # the most that two pieces beside j can hold
        for x in lengths[:np.searchsorted(lengths, room, "right")].tolist():
            at = int(np.searchsorted(lengths, room - x, "right")) - 1
            while at >= 0 and lengths[at] == x and counts[x] < 2:
                at -= 1
            if at >= 0:
                best = max(best, x + int(lengths[at]))
        if a >= best:
            return [a]
        counts[a] -= 1
        fits = [int(x) for x in lengths[:np.searchsorted(lengths, room - a, "right")] if counts[x]]
        counts[a] += 1
        if not fits:
            return None
        longer = smallest(fits[-1], 2)
        return [a, fits[-1]] if longer is None or longer > room else None
    finally:
        counts[j] += 1


def best_fit(counts: np.ndarray, capacity: int, plan: Plan) -> None:
    """Best fit, longest first: a piece goes where the least room is left that holds it."""
    gaps: dict[int, list[tuple[int, int]]] = {}  # room left -> runs (first sequence, count)
    rooms: list[int] = []                        # sorted keys of gaps

    def leave(room: int, first: int, count: int) -> None:
        if room and count:
            if room not in gaps:
                rooms.insert(bisect_left(rooms, room), room)
                gaps[room] = []
            gaps[room].append((first, count))

    for length in np.flatnonzero(counts)[::-1].tolist():
        left = int(counts[length])
        while left:
            at = bisect_left(rooms, length)
            if at == len(rooms):
                room, first, count = capacity, None, -(-left // (capacity // length))
                first = plan.open(count)
            else:
                room = rooms[at]
                first, count = gaps[room].pop()
                if not gaps[room]:
                    del gaps[room], rooms[at]
            each = min(room // length, left)
            take = min(count, left // each)
            plan.put(length, take * each, each, first, capacity - room)
            left -= take * each
            leave(room - each * length, first, take)
            leave(room, first + take, count - take)
        counts[length] = 0


def plan_sequences(counts: np.ndarray, capacity: int = CAPACITY) -> Plan:
    """A plan for ``counts[length]`` pieces of every length up to ``capacity``."""
    counts, plan = counts.astype(np.int64).copy(), Plan()
    if counts[0]:  # empty pieces take no room
        plan.put(0, int(counts[0]), int(counts[0]), plan.open(1), 0)
        counts[0] = 0
    reduce_dominated(counts, capacity, plan)
    best_fit(counts, capacity, plan)
    return plan


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (doc_id, piece, length and more) with sequence_id and offset.

    Lengths lie between 0 and ``capacity``.  All rows come back; repeated rows
    are pieces of their own.  ``pieces`` should be stored: it is read twice.
    """
    keyed = stored(dense_key(pieces.withColumnsRenamed({c: f"p_{c}" for c in pieces.columns})
                             .withColumns({"length": F.col("p_length"), "piece": F.col("p_piece"),
                                           "doc_id": F.col("p_doc_id")}),
                             ["length", "doc_id", "piece"], "at"), "pack_keyed")
    counts = np.zeros(capacity + 1, dtype=np.int64)
    for row in keyed.groupBy("length").count().collect():  # at most capacity + 1 rows
        counts[row["length"]] = row["count"]
    plan = plan_sequences(counts, capacity)
    before = np.cumsum(counts) - counts
    runs = []
    for length in sorted(plan.runs):
        at = int(before[length]) + 1
        for count, each, sequence, offset in plan.runs[length]:
            runs.append((at, each, sequence, offset))
            at += count
    starts, each, first, offset = (np.array(x, dtype=np.int64) for x in zip(*runs)) if runs else [
        np.empty(0, np.int64)] * 4

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at, length = (b.column(c).to_numpy() for c in ("at", "length"))
            run = np.searchsorted(starts, at, "right") - 1
            nth = at - starts[run]
            yield (b.drop_columns(["at", "length"])
                   .append_column("sequence_id", pa.array(first[run] + nth // each[run]))
                   .append_column("offset", pa.array(offset[run] + nth % each[run] * length)))

    kept = [f for f in pieces.schema if f.name not in ("sequence_id", "offset")]
    fields = ", ".join(f"`p_{f.name}` {f.dataType.simpleString()}" for f in kept)
    return (keyed.select(*[f"p_{f.name}" for f in kept], "at", "length")
            .mapInArrow(place, f"{fields}, sequence_id long, offset long")
            .withColumnsRenamed({f"p_{f.name}": f.name for f in kept}))


def token_pieces(docs: DataFrame, tokenizer: str, end_id: int = 1, capacity: int = CAPACITY,
                 with_ids: bool = False) -> DataFrame:
    """Documents as pieces of at most ``capacity`` tokens: doc_id, piece, start, length, ids_crc32.

    The ids of the whole text (NULL: empty) and ``end_id`` are cut every
    ``capacity`` tokens.  ``with_ids`` adds the ids themselves (binary,
    little-endian uint32).
    """
    step = 4 * capacity

    def cut(batches: Iterator[list]) -> Iterator[list[tuple]]:
        encode, end = encoder(tokenizer).ids, np.array([end_id], "<u4").tobytes()
        for docs, texts in batches:
            rows = []
            for doc, ids in zip(docs, encode(texts)):
                ids += end
                for k in range(0, len(ids), step):
                    part = ids[k:k + step]
                    rows.append((doc, k // step, k // 4, len(part) // 4, zlib.crc32(part),
                                 *([part] if with_ids else [])))
            yield rows

    return map_rows(docs.select("doc_id", "text"), cut, "doc_id long, piece int, start long, "
                    "length long, ids_crc32 long" + ", ids binary" * with_ids)


def packed_documents(docs: DataFrame, tokenizer: str, end_id: int = 1, capacity: int = CAPACITY,
                     with_ids: bool = False) -> DataFrame:
    """Pieces of :func:`token_pieces` with their sequence and the place in it.

    Every row is packed, repeated ones and those without an id too; a NULL or empty text is its end id
    alone, and a long one fills as many pieces as it needs, encoded whole in one task.  Which of equally
    long pieces lies where is settled by their ids; empty ``docs`` give no rows."""
    return pack(stored(token_pieces(docs, tokenizer, end_id, capacity, with_ids), "pack_pieces"), capacity)
