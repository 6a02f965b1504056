"""Quality rules: gradient-boosted trees over document statistics.

The trees are grown on a bounded sample of labelled documents (``SAMPLE`` rows,
their statistics only), with monotonic constraints: more symbols, repeats,
duplicate lines or capitals never raise a verdict.  They are then flattened
into numpy node arrays (complete trees in heap order), and a whole Arrow batch
of documents walks down all trees at once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .labelled import labelled_sample, one_row_each

SAMPLE = 20_000
SPACE = b" \t\n\x0b\x0c\r"
SYMBOLS = b"#*$%&|<>"
UPPER = bytes(range(65, 91))
LETTERS = UPPER + bytes(range(97, 123))
DIGITS = b"0123456789"

BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
FEATURES = ["log_words", "word_length", "symbols", "dup_lines", "repeats", "capitals", "bangs",
            "digits", "distinct", "stutter", "words_per_line", "stops"]
#: -1: a larger value never raises the score, 0: free.
MONOTONE = {"symbols": -1, "dup_lines": -1, "repeats": -1, "capitals": -1, "bangs": -1, "stutter": -1}


def _count(b: bytes, chars: bytes) -> int:
    return len(b) - len(b.translate(None, chars))


def repeated_words(codes: np.ndarray, window: int = 3) -> int:
    """Words that lie in a window of ``window`` words found twice or more."""
    n = len(codes) - window + 1
    if n < 2:
        return 0
    key = codes[:n]
    for k in range(1, window):
        side = int(codes.max()) + 1
        if int(key.max()) >= (1 << 62) // side:
            key = np.unique(key, return_inverse=True)[1]
        key = key * side + codes[k:n + k]
    _, at, times = np.unique(key, return_inverse=True, return_counts=True)
    again, covered = times[at] > 1, np.zeros(len(codes), dtype=bool)
    for k in range(window):
        covered[k:n + k] |= again
    return int(covered.sum())


def statistics(text: str | None) -> tuple[list[int], list[float]]:
    """(BASE, FEATURES) of one whole text; a NULL text has no words.

    Words are runs of anything but ASCII white space.  Lines end at \\n; a line
    that has a word and equals an earlier one is a duplicate.
    """
    text = text or ""
    raw = text.encode("utf-8", "replace")
    words = raw.split()
    n = len(words)
    codes: dict[bytes, int] = {}
    code = np.array([codes.setdefault(w, len(codes)) for w in words], dtype=np.int64)
    lines = [x for x in raw.split(b"\n") if x.strip(SPACE)]
    dup = len(lines) - len(set(lines))
    symbols, repeats = _count(raw, SYMBOLS), repeated_words(code)
    chars = len(text) - _count(raw, SPACE)
    some, letters = max(n, 1), max(1, _count(raw, LETTERS))
    stutter = int((code[1:] == code[:-1]).sum())
    return ([n, chars, symbols, dup, repeats],
            [np.log2(n + 1.0), chars / some, symbols / some, dup / max(1, len(lines)), repeats / some,
             _count(raw, UPPER) / letters, raw.count(b"!") / some, _count(raw, DIGITS) / max(1, chars),
             len(codes) / some, stutter / some, n / max(1, len(lines)), _count(raw, b".,;:?") / some])


@dataclass
class Trees:
    """Complete binary trees in heap order, one row per tree."""
    feature: np.ndarray    # (trees, inner nodes) column to test
    threshold: np.ndarray  # go right if the value is above it
    value: np.ndarray      # (trees, leaves)
    start: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for each row of ``x``."""
        total = np.full(len(x), self.start)
        rows = np.arange(len(x))
        for feature, threshold, value in zip(self.feature, self.threshold, self.value):
            node = np.zeros(len(x), dtype=np.int64)
            while len(node) and node[0] < len(feature):  # all rows are on one level
                node = 2 * node + 1 + (x[rows, feature[node]] > threshold[node])
            total += value[node - len(feature)]
        return 1 / (1 + np.exp(-total))


def grow_trees(x: np.ndarray, y: np.ndarray, monotone: np.ndarray, rounds: int = 60, depth: int = 3,
               bins: int = 32, rate: float = 0.2, ridge: float = 1.0) -> Trees:
    """Boosted trees for a 0/1 label by second-order steps on binned features."""
    inner = 2 ** depth - 1
    share = float(np.clip(y.mean() if len(y) else 0.5, 1e-3, 1 - 1e-3))
    start = float(np.log(share / (1 - share)))
    feature = np.zeros((rounds, inner), dtype=np.int64)
    threshold = np.full((rounds, inner), np.inf)
    value = np.zeros((rounds, inner + 1))
    if not len(y) or y.min() == y.max():
        return Trees(feature[:0], threshold[:0], value[:0], start if len(y) else 0.0)
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1])) for c in x.T]
    binned = np.stack([np.searchsorted(e, c, "left") for e, c in zip(edges, x.T)], axis=1)
    total = np.full(len(y), start)
    for r in range(rounds):
        p = 1 / (1 + np.exp(-total))
        grad, hess = y - p, p * (1 - p)
        node, low, high = np.zeros(len(y), dtype=np.int64), {0: -np.inf}, {0: np.inf}
        for k in range(inner):
            here = np.flatnonzero(node == k)
            lo, hi = low[k], high[k]
            split = _best_split(binned[here], grad[here], hess[here], edges, monotone, lo, hi, ridge)
            mid = (lo, hi)
            if split:
                f, cut, left, right = split
                feature[r, k], threshold[r, k] = f, edges[f][cut]
                node[here] = 2 * k + 1 + (binned[here, f] > cut)
                m = (left + right) / 2
                mid = (m, hi) if monotone[f] > 0 else (lo, m) if monotone[f] < 0 else (lo, hi)
                other = (lo, m) if monotone[f] > 0 else (m, hi) if monotone[f] < 0 else (lo, hi)
            else:  # an endless threshold: all rows go left
                node[here], other = 2 * k + 1, (lo, hi)
            (low[2 * k + 1], high[2 * k + 1]), (low[2 * k + 2], high[2 * k + 2]) = other, mid
        leaf = node - inner
        g = np.bincount(leaf, grad, inner + 1)
        h = np.bincount(leaf, hess, inner + 1)
        value[r] = rate * np.clip(g / (h + ridge), [low[inner + i] for i in range(inner + 1)],
                                  [high[inner + i] for i in range(inner + 1)])
        total += value[r][leaf]
    return Trees(feature, threshold, value, start)


def _best_split(binned, grad, hess, edges, monotone, lo, hi, ridge):
    """(feature, bin, left value, right value) of the best allowed split, or None."""
    best, found = 1e-6, None
    if len(grad) < 2:
        return None
    base = grad.sum() ** 2 / (hess.sum() + ridge)
    for f, e in enumerate(edges):
        g = np.cumsum(np.bincount(binned[:, f], grad, len(e) + 1))
        h = np.cumsum(np.bincount(binned[:, f], hess, len(e) + 1))
        gl, hl, gr, hr = g[:-1], h[:-1], g[-1] - g[:-1], h[-1] - h[:-1]
        left, right = (np.clip(a / (b + ridge), lo, hi) for a, b in ((gl, hl), (gr, hr)))
        gain = (2 * gl * left - (hl + ridge) * left ** 2 + 2 * gr * right - (hr + ridge) * right ** 2) - base
        ok = (hl > 1e-3) & (hr > 1e-3) & (monotone[f] * (right - left) >= 0)
        gain = np.where(ok, gain, -np.inf)
        if len(gain) and gain.max() > best:
            cut = int(gain.argmax())
            best, found = gain[cut], (f, cut, left[cut], right[cut])
    return found


def fit(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE) -> Trees:
    """Trees for the labelled quality, from at most ``rows`` labelled documents.

    Of rows that repeat a doc_id one is used.  Without labels every document scores 0.5.
    """
    def stats(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"doc_id": b["doc_id"], "label": b["label"],
                                "x": [statistics(t)[1] for t in b["text"]]})

    sample = labelled_sample(docs, labels, rows)
    got = one_row_each(sample.mapInPandas(stats, "doc_id long, label int, x array<double>")).toPandas()
    x = np.array(got["x"].tolist(), dtype=float).reshape(-1, len(FEATURES))
    order = np.lexsort([got["label"], *x.T])  # the order of rows must not matter
    monotone = np.array([MONOTONE.get(f, 0) for f in FEATURES])
    return grow_trees(x[order], got["label"].to_numpy(dtype=float)[order], monotone)


_OUT = "struct<" + ", ".join(f"{c}: bigint" for c in BASE) + ", score: double>"


def rule_scores(text, trees: Trees):
    """Struct column of the BASE statistics and the trees' score of whole texts."""
    @F.pandas_udf(_OUT)
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            both = [statistics(t) for t in texts]
            out = pd.DataFrame([b for b, _ in both], columns=BASE, dtype="int64")
            x = np.array([f for _, f in both], dtype=float).reshape(-1, len(FEATURES))
            yield out.assign(score=trees.score(x))
    return of(text)


def judged(docs: DataFrame, trees: Trees, into: str) -> DataFrame:
    """``docs`` with a struct column ``into``: BASE, base_failed, score, kept.

    base_failed: fewer than 50 words, or more than half of them in repeated
    3-word windows.  kept: not base_failed and a score of 0.5 or more.  NULL and
    empty texts have no words and fail.  Every row of ``docs`` comes back.
    """
    s = F.col(into)
    failed = (s["n_words"] < 50) | (100 * s["n_repeat_words"] > 50 * s["n_words"])
    return (docs.withColumn(into, rule_scores(F.col("text"), trees))
            .withColumn(into, s.withField("base_failed", failed)
                        .withField("kept", ~failed & (s["score"] >= 0.5))))
