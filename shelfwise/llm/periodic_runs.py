"""Periodic runs of words, found by seeds that are extended along diagonals.

A run is a stretch of words with smallest period ``q`` (words ``q`` apart are
identical) and at least ``max(12, 2q)`` words that no neighbouring word extends.
On the diagonal of lag ``q`` (words ``i`` and ``i + q`` compared) it is a maximal
streak of equal words, ``max(12 - q, q)`` long at least.  So lags up to 7 share
k-grams of 6 words, and lags from ``k`` to ``2k - 1`` share k-grams of ``k`` words,
for ``k`` = 8, 16, 32, ...: the minimum overlap that such a run guarantees.

For each ``k`` the k-grams that occur twice in a document are indexed by name
(exact names: a gram of ``2k`` words is a pair of names of its halves), pairs of
occurrences at a lag of the class are enumerated, and each pair is extended to its
whole streak.  A table of how far each lag is covered suppresses extensions of
a streak already known.

Texts that repeat a short period many times have k-grams that occur everywhere.
Within a run found before (period ``p`` up to ``k / 2``) occurrences of one k-gram
are ``p`` apart, so one of them stands for all (first, step, last), and pairs
inside one run, whose streak is that run, are left out.  Of a pair at least one
member is then a first occurrence: if both lay a period or more inside their runs,
the streak could be extended to the left.  That leaves a number of pairs in
proportion to the words of each class.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Shortest run in words, and longest lag of the first class (grams of 6 words).
LEAST = 12
FIRST_LAGS, FIRST_GRAM = 7, 6
#: Documents are searched together until they have so many words.
_GROUP = 400_000


def _named(a: np.ndarray, b: np.ndarray, shift: int, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Names of grams made of ``a`` at ``i`` and ``b`` at ``i + shift``, for the ``i`` in ``at``.

    Returns the names of all positions (-1: the gram occurs once) and the
    positions whose gram occurs twice or more, ascending.
    """
    at = at[at + shift < len(b)]
    at = at[(a[at] >= 0) & (b[at + shift] >= 0)]
    code, distinct = pd.factorize(a[at] * np.int64(b.max(initial=0) + 1) + b[at + shift])
    again = np.bincount(code, minlength=len(distinct))[code] > 1
    names = np.full(len(a), -1, dtype=np.int64)
    names[at[again]] = code[again]
    return names, at[again]


def _streak(words: np.ndarray, i: int, lag: int) -> tuple[int, int]:
    """The whole streak of equal words on a diagonal around ``i``: [start, end)."""
    end, step, n = i, 64, len(words) - lag
    while end < n:
        stop = min(n, end + step)
        differs = words[end:stop] != words[end + lag:stop + lag]
        k = int(differs.argmax())
        if differs[k]:
            end += k
            break
        end, step = stop, 4 * step
    start, step = i, 64
    while start > 0:
        stop = max(0, start - step)
        differs = (words[stop:start] != words[stop + lag:start + lag])[::-1]
        k = int(differs.argmax())
        if differs[k]:
            start -= k
            break
        start, step = stop, 4 * step
    return start, end


class _Found:
    """Runs found so far: columns start, end, period."""

    def __init__(self):
        self.rows = np.empty((0, 3), dtype=np.int64)

    def furthest(self, rows: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each place: the furthest end among runs that start there or before, and the
        row of that run (-1: none)."""
        if not len(rows):
            return np.zeros(len(at), dtype=np.int64), np.full(len(at), -1)
        order = np.lexsort((rows[:, 1], rows[:, 0]))
        ends = rows[order, 1]
        top = np.maximum.accumulate(ends)
        leads = np.maximum.accumulate(np.where(ends == top, np.arange(len(ends)), 0))
        k = np.searchsorted(rows[order, 0], at, "right") - 1
        some = k >= 0
        return np.where(some, top[k], 0), np.where(some, order[leads[k]], -1)

    def add(self, start: np.ndarray, end: np.ndarray, lag: int | np.ndarray) -> None:
        """Streaks [start, end) of ``lag`` that are runs and repeat no shorter period."""
        length = end - start
        rows = np.stack([start, end + lag, np.broadcast_to(lag, start.shape)], axis=1)
        rows = rows[(length >= lag) & (length + lag >= LEAST)]
        for q in np.unique(rows[:, 2]):
            new = rows[rows[:, 2] == q]
            shorter = self.rows[self.rows[:, 2] < q]
            self.rows = np.concatenate([self.rows, new[self.furthest(shorter, new[:, 0])[0] < new[:, 1]]])


def _pairs(names: np.ndarray, at: np.ndarray, k: int, found: _Found) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(place, lag) of occurrences of one k-gram, ``k`` to ``2k - 1`` apart."""
    runs = found.rows[(2 * found.rows[:, 2] <= k) & (found.rows[:, 1] - found.rows[:, 0] >= k)]
    end, run = found.furthest(runs, at)
    inside = (run >= 0) & (end >= at + k)
    period = np.where(inside, runs[run, 2] if len(runs) else 1, 1)
    first = ~inside | (at - (runs[run, 0] if len(runs) else 0) < period)
    last = np.where(inside, at + (end - k - at) // period * period, at)
    at, period, last = at[first], period[first], last[first]
    order = np.argsort(names[at], kind="stable")
    at, period, last, name = at[order], period[order], last[order], names[at][order]
    for t in range(1, len(at)):
        r = np.flatnonzero((name[t:] == name[:-t]) & (at[t:] - last[:-t] < 2 * k))
        if not len(r):
            return
        one, other = r, r + t
        # the later first occurrence and all earlier ones, then the earlier first one and all later ones
        for low, high, base, step, most, fixed, sign in (
                (at[other] - 2 * k + 1, at[other] - k, at[one], period[one], last[one], at[other], -1),
                (at[one] + k, at[one] + 2 * k - 1, at[other], period[other], last[other], at[one], 1)):
            x0 = np.maximum(0, -((base - low) // step))
            x1 = (np.minimum(high, most) - base) // step
            n = np.maximum(0, x1 - x0 + 1)
            k_th = np.repeat(x0 - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
            place = np.repeat(base, n) + k_th * np.repeat(step, n)
            fixed = np.repeat(fixed, n)
            yield np.minimum(place, fixed), sign * (place - fixed)


def find_runs(words: np.ndarray) -> np.ndarray:
    """All runs of a sequence of word codes as rows (start, length, period), by start, then period.

    Several documents can be searched together if their codes differ.
    """
    one = np.asarray(words, dtype=np.int64)
    found = _Found()
    if len(one) < LEAST:
        return found.rows
    two, at2 = _named(one, one, 1, np.arange(len(one)))
    four, at4 = _named(two, two, 2, at2)
    six, at = _named(four, two, 4, at4)
    # all occurrences at lags up to 7 are seeds, so a chain of seeds is a whole streak
    order = np.argsort(six[at], kind="stable")
    place, name = at[order], six[at][order]
    seeds = [[] for _ in range(FIRST_LAGS + 1)]
    for t in range(1, FIRST_LAGS + 1):
        near = np.flatnonzero((name[t:] == name[:-t]) & (place[t:] - place[:-t] <= FIRST_LAGS))
        lags = place[near + t] - place[near]
        for q in range(t, FIRST_LAGS + 1):
            seeds[q].append(place[near[lags == q]])
    for q in range(1, FIRST_LAGS + 1):
        i = np.sort(np.concatenate(seeds[q]))
        if len(i):
            head = np.flatnonzero(np.diff(i, prepend=i[0] - 2) > 1)
            found.add(i[head], i[np.append(head[1:], len(i)) - 1] + FIRST_GRAM, q)
    k, (names, at) = 8, _named(four, four, 4, at4)
    while len(at):
        got = list(_pairs(names, at, k, found))
        if got:
            i, lag = (np.concatenate(x) for x in zip(*got))
            order = np.lexsort((i, lag))
            i, lag = i[order], lag[order]
            # a seed within k words of the one before it on its lag continues its streak
            head = np.flatnonzero((np.diff(lag, prepend=-1) != 0) | (np.diff(i, prepend=-1) > k))
            covered: dict[int, int] = {}
            streaks = []
            for p, q in zip(i[head].tolist(), lag[head].tolist()):
                if p >= covered.get(q, 0):
                    start, end = _streak(one, p, q)
                    covered[q] = end
                    streaks.append((start, end, q))
            found.add(*np.array(streaks, dtype=np.int64).reshape(-1, 3).T)
        names, at = _named(names, names, k, at)
        k *= 2
    rows = found.rows[np.lexsort((found.rows[:, 2], found.rows[:, 0]))]
    return np.stack([rows[:, 0], rows[:, 1] - rows[:, 0], rows[:, 2]], axis=1)


def _searched(texts: list[bytes]) -> Iterator[tuple[np.ndarray, bytes]]:
    """(runs, text without repeats) of each text of a group."""
    words = [t.split() for t in texts]  # bytes split at exactly the white space that ends a word
    n = np.array([len(w) for w in words], dtype=np.int64)
    first = np.cumsum(n) - n
    codes = pa.array([x for w in words for x in w], pa.binary()).dictionary_encode().indices
    codes = codes.to_numpy(zero_copy_only=False).astype(np.int64)
    doc = np.repeat(np.arange(len(words)), n)
    runs = find_runs(pd.factorize(doc * (codes.max(initial=0) + 1) + codes)[0])
    drop = np.zeros(len(doc) + 1, dtype=np.int64)
    np.add.at(drop, runs[:, 0] + runs[:, 2], 1)
    np.add.at(drop, runs[:, 0] + runs[:, 1], -1)
    kept = np.cumsum(drop[:-1]) == 0
    cut = np.searchsorted(runs[:, 0], np.append(first, len(doc)))
    for k, w in enumerate(words):
        here = runs[cut[k]:cut[k + 1]] - np.array([first[k], 0, 0])
        if len(here):
            w = [w[x] for x in np.flatnonzero(kept[first[k]:first[k] + n[k]])]
        yield here, b" ".join(w)


def _groups(texts: list[bytes | None]) -> Iterator[list[bytes]]:
    group, size = [], 0
    for t in texts:
        group.append(t or b"")
        size += len(group[-1])
        if size > 6 * _GROUP:
            yield group
            group, size = [], 0
    if group:
        yield group


_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
_SCHEMA = pa.schema([("doc_id", pa.int64()), ("runs", _RUNS), ("collapsed", pa.string())])


def document_runs(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, runs (array of start, length, period), collapsed.

    Words are maximal runs of anything but ASCII space and \\t \\n \\v \\f \\r, numbered
    from 0; runs come by start, then period.  ``collapsed`` holds the words that no run
    contains after its first period, joined by one space.  NULL and empty texts
    have no runs and an empty ``collapsed``; repeated rows and rows without an id come
    back one by one; other columns are not read.  Texts are searched whole, one row in
    one task: time grows as words times the logarithm of the longest period.
    """
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, at = batch.column(0), 0
            for group in _groups(batch.column(1).to_pylist()):
                found, texts = zip(*_searched(group))
                rows = np.concatenate(found)
                fields = [pa.array(np.ascontiguousarray(rows[:, c])) for c in range(3)]
                offsets = pa.array(np.cumsum([0, *map(len, found)]), pa.int32())
                runs = pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays(fields, fields=list(_RUNS.value_type)))
                yield pa.RecordBatch.from_arrays(
                    [pc.cast(ids.slice(at, len(group)), pa.int64()), runs.cast(_RUNS),
                     pa.array(texts, pa.binary()).cast(pa.string())], schema=_SCHEMA)
                at += len(group)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary").alias("text")).mapInArrow(
        search, "doc_id long, runs array<struct<start:long,length:long,period:long>>, collapsed string")


def looped(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text) with a planted period in about a tenth of the texts.

    Let h = crc32 of the doc_id in decimal, g = floor(h / 10).  If 10 divides h, each word
    i >= a of the n words becomes word a + (i - a) % p, where a = g % n and
    p = 1 + floor((n - a) / (3 + g % 8)).  Texts without words or without an id stay.
    """
    words = F.regexp_extract_all("text", F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1))
    code = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    turned = (docs.select("doc_id", "text", code.alias("code"))
              .withColumn("words", F.when(F.col("code") % 10 == 0, words))
              .withColumn("n", F.size("words"))
              .withColumn("a", F.expr("IF(n > 0, CAST((code DIV 10) % n AS INT), NULL)"))
              .withColumn("p", F.expr("CAST(1 + (n - a) DIV (3 + (code DIV 10) % 8) AS INT)")))
    return turned.select("doc_id", F.expr(
        "IF(a IS NULL, text, array_join(concat(slice(words, 1, a), transform(sequence(0, n - a - 1), "
        "i -> words[a + i % p])), ' '))").alias("text"))


def run_digests(docs: DataFrame) -> DataFrame:
    """Per row of ``docs`` (after :func:`looped`): its longest run and digests of all of them."""
    best = F.expr("reduce(runs, CAST(NULL AS struct<start:long,length:long,period:long>), "
                  "(b, r) -> IF(b IS NULL OR r.length > b.length, r, b))")
    lines = F.expr("array_join(transform(runs, r -> concat_ws(',', r.start, r.length, r.period) || '\\n'), '')")
    return document_runs(looped(docs)).withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length DIV best.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
