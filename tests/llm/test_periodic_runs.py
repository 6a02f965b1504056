import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from shelfwise.llm import periodic_runs

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_runs(w):
    """Every lag on its own, word by word."""
    out, n = [], len(w)
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            if w[i] != w[i + q]:
                i += 1
                continue
            s = i
            while i + q < n and w[i] == w[i + q]:
                i += 1
            x = w[s:i + q]
            if len(x) >= max(12, 2 * q) and not any(x[p:] == x[:-p] for p in range(1, q)):
                out.append((s, len(x), q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def made(rnd):
    kind, n = rnd.randrange(5), rnd.randint(0, 140)
    if kind == 0:
        return [rnd.randint(0, rnd.choice([0, 1, 2, 3])) for _ in range(n)]
    if kind == 1:
        w = []
        while len(w) < n:
            block = [rnd.randint(0, 2) for _ in range(rnd.randint(1, 20))]
            w += (block * rnd.randint(1, 8))[:rnd.randint(1, 90)]
        return w
    if kind == 2:  # runs of one period that touch
        a, b = rnd.randint(1, 40), rnd.randint(1, 40)
        return [0, 1] * a + [0] + [0, 1] * b + [0] * rnd.randint(0, 3) + [0, 1] * rnd.randint(0, 30)
    if kind == 3:
        return list(range(n)) * rnd.randint(1, 3)
    x, y = [0], [0, 1]
    for _ in range(rnd.randint(3, 8)):
        x, y = y, y + x
    y[rnd.randrange(len(y))] = 2
    return y


@pytest.mark.parametrize("seed", range(40))
def test_runs_equal_all_lags(seed):
    rnd = random.Random(seed)
    for _ in range(25):
        w = made(rnd)
        assert [tuple(r) for r in periodic_runs.find_runs(np.array(w, dtype=np.int64)).tolist()] == plain_runs(w)


def test_long_repetitive_texts_stay_cheap():
    for p in (1, 2, 3, 7, 9, 100):
        assert periodic_runs.find_runs(np.arange(200_000) % p).tolist() == [[0, 200_000, p]]
    w = [0, 1] * 2000 + [0] + [0, 1] * 2000  # a run for every odd period around the middle
    assert len(periodic_runs.find_runs(np.array(w))) == 1999


def plain(doc_id, text):
    w = WORD.findall(text or "")
    n = len(w)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = w[:a] + [w[a + (i - a) % p] for i in range(a, n)]
    runs = plain_runs(w)
    drop = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=(None,) * 3)
    return (doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
            hashlib.sha256("".join(f"{s},{length},{q}\n" for s, length, q in runs).encode()).hexdigest(),
            hashlib.sha256(" ".join(x for i, x in enumerate(w) if i not in drop).encode()).hexdigest())


def test_digests_over_awkward_rows(spark, awkward, clashing, nothing, awkward_rows):
    small = [r for r in awkward_rows if len(r[1] or "") < 20_000]
    extra = [(k, "ab cd " * k, None, None, None) for k in range(2, 60)]
    extra += [(500 + k, "x y z " + "one two three four five " * k + "end\n" * k, None, None, None) for k in range(30)]
    rows = small + extra
    docs = spark.createDataFrame(rows, awkward.schema)
    want = sorted((plain(r[0], r[1]) for r in rows), key=repr)
    assert any(w[1] for w in want) and any(zlib.crc32(str(r[0]).encode()) % 10 == 0 for r in rows if r[0])
    assert sorted((tuple(r) for r in periodic_runs.run_digests(docs).collect()), key=repr) == want
    # whole long texts, other columns, no rows
    assert periodic_runs.run_digests(clashing).count() == len(awkward_rows)
    assert periodic_runs.run_digests(nothing).collect() == []


def test_spans_and_text_of_a_long_document(spark):
    text = "a b c " * 40_000 + "the end"
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    [row] = periodic_runs.document_runs(docs).collect()
    assert [tuple(r) for r in row.runs] == [(0, 120_000, 3)] and row.collapsed == "a b c the end"
