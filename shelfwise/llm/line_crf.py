"""Quality classifier: a linear-chain conditional random field over lines.

Each line with a word gets small bucketed features; the emission score of a
line adds the weights of its own buckets and of those of the lines before and
after it, and two states (good, bad) follow each other with learned odds.
Forward-backward marginals of "bad", weighted by line length, give the share
of bad text, and a logistic curve fitted on the same sample turns it into the
score.

Labels exist for documents only.  A first fit without transitions takes every
line to be as its document; lines of bad documents that this fit finds good
are relabelled, and the chain is fitted on the result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .labelled import labelled_sample, one_row_each

#: Bounds of the sample that the model is fitted on.
SAMPLE = 4_000

_UPPER = bytes(range(65, 91))
_LETTERS = _UPPER + bytes(range(97, 123))
_HIGH = bytes(range(128, 256))
_SHARES = (1e-9, 0.02, 0.05, 0.1, 0.2, 0.4, 0.7)
_EDGES = [
    (16, 32, 64, 128, 256, 512, 1024),      # bytes
    (2, 3, 4, 5, 6, 8, 12),                 # bytes a word
    _SHARES, _SHARES, _SHARES, _SHARES, _SHARES, _SHARES,  # see _measure
    (0.1, 0.25, 0.4, 0.55, 0.7, 0.85, 0.97),  # distinct words
    (0.5,),                                 # seen before in the document
    (1e-9, 0.03, 0.06, 0.1, 0.15, 0.25, 0.5),  # stops and commas a word
    (0.5, 1.5, 2.5),                        # how it begins and ends
]
_N, _NONE = len(_EDGES), 8                  # features; the bucket of a missing neighbour
_WIDTH = 3 * _N * (_NONE + 1)


def _share(line: bytes, chars: bytes) -> int:
    return len(line) - len(line.translate(None, chars))


def _measure(line: bytes, seen: bool) -> tuple:
    words = line.split()
    n = len(words)
    return (len(line), len(line) / n, _share(line, b"#*$%&<>") / n, _share(line, _UPPER) / max(1, _share(line, _LETTERS)),
            _share(line, b"0123456789") / len(line), line.count(b"!") / n, line.count(b"|") / n,
            sum(map(eq, words, words[1:])) / n, len(set(words)) / n, seen,
            _share(line, b".,;:?") / n, 2 * line[:1].isupper() + (line.rstrip()[-1:] in b".?!"))


def line_features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, bytes) of the lines with a word; lines end at \\n."""
    rows, seen = [], set()
    for line in (text or "").encode("utf-8", "replace").split(b"\n"):
        if line.strip():
            rows.append(_measure(line, line in seen))
            seen.add(line)
    values = np.array(rows, dtype=float).reshape(-1, _N)
    buckets = np.stack([np.searchsorted(e, c, "right") for e, c in zip(_EDGES, values.T)], axis=1)
    return buckets.astype(np.uint8), values[:, 0]


def _codes(buckets: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Weight numbers of each line: own, previous and next line's buckets."""
    ends = np.cumsum(lengths)
    before, after = np.full_like(buckets, _NONE), np.full_like(buckets, _NONE)
    before[1:], after[:-1] = buckets[:-1], buckets[1:]
    full = lengths > 0
    before[(ends - lengths)[full]] = _NONE
    after[ends[full] - 1] = _NONE
    three = np.concatenate([buckets, before, after], axis=1).astype(np.int64)
    return three + (_NONE + 1) * np.arange(3 * _N)


def marginals(emission: np.ndarray, lengths: np.ndarray, chain: np.ndarray):
    """Marginals of "good" and, for the fit, expected counts of state pairs.

    ``emission``: log-odds of good per line, documents one after another;
    ``chain``: log potentials [from][to] of (bad, good).
    """
    order = np.argsort(-lengths, kind="stable")
    start, length = (np.cumsum(lengths) - lengths)[order], lengths[order]
    score = np.stack([np.zeros_like(emission), emission], axis=1)
    ahead, behind = score.copy(), np.zeros_like(score)
    steps = int(length[0]) if len(length) else 0
    live = [int(np.searchsorted(-length, -t, "left")) for t in range(steps + 1)]
    for t in range(1, steps):
        at = start[:live[t]] + t
        ahead[at] += np.logaddexp(ahead[at - 1, :1] + chain[0], ahead[at - 1, 1:] + chain[1])
    for t in range(steps - 1, 0, -1):
        at = start[:live[t]] + t
        nxt = (score[at] + behind[at])[:, None, :] + chain
        behind[at - 1] = np.logaddexp(nxt[:, :, 0], nxt[:, :, 1])
    both = ahead + behind
    good = 1 / (1 + np.exp(np.clip(both[:, 0] - both[:, 1], -500, 500)))
    follow = np.ones(len(emission), dtype=bool)
    follow[(np.cumsum(lengths) - lengths)[lengths > 0]] = False
    at = np.flatnonzero(follow)
    pair = ahead[at - 1][:, :, None] + chain + (score[at] + behind[at])[:, None, :]
    norm = np.logaddexp(both[at, 0], both[at, 1])
    return good, np.exp(np.minimum(pair - norm[:, None, None], 0)).sum(axis=0), at


@dataclass
class LineModel:
    weights: np.ndarray
    chain: np.ndarray
    curve: tuple[float, float]  # score = logistic(a - b * share of bad text)

    def bad_share(self, texts) -> np.ndarray:
        """Length-weighted marginal of "bad" per text; 1 for a text without words."""
        found = [line_features(t) for t in texts]
        lengths = np.array([len(b) for b, _ in found], dtype=np.int64)
        if not lengths.sum():
            return np.ones(len(found))
        buckets = np.concatenate([b for b, _ in found])
        size = np.concatenate([s for _, s in found])
        return self._weigh(_codes(buckets, lengths), lengths, size)

    def _weigh(self, codes, lengths, size) -> np.ndarray:
        good, _, _ = marginals(self.weights[codes].sum(axis=1), lengths, self.chain)
        doc = np.repeat(np.arange(len(lengths)), lengths)
        mass = np.bincount(doc, size, len(lengths))
        bad = np.bincount(doc, size * (1 - good), len(lengths))
        return np.where(mass > 0, bad / np.maximum(mass, 1), 1.0)

    def score(self, texts) -> np.ndarray:
        a, b = self.curve
        return 1 / (1 + np.exp(-np.clip(a - b * self.bad_share(texts), -500, 500)))


def _fit_chain(codes, lengths, good, with_chain: bool, steps: int = 150, rate: float = 0.1,
               ridge: float = 1e-3) -> tuple[np.ndarray, np.ndarray]:
    """Penalised maximum likelihood by Adam steps; ``good`` labels every line."""
    w, chain, n = np.zeros(_WIDTH), np.zeros((2, 2)), len(codes)
    share = np.clip(good.mean(), 0.01, 0.99)
    w[:_NONE + 1] = np.log(share / (1 - share))
    flat = codes.ravel()
    _, _, at = marginals(np.zeros(n), lengths, chain)
    seen = np.zeros((2, 2))
    np.add.at(seen, (good[at - 1].astype(int), good[at].astype(int)), 1)
    m, v = np.zeros(_WIDTH + 4), np.zeros(_WIDTH + 4)
    for k in range(1, steps + 1):
        p, pairs, _ = marginals(w[codes].sum(axis=1), lengths, chain)
        grad = np.bincount(flat, np.repeat(good - p, codes.shape[1]), _WIDTH) / n - ridge * w
        turn = (seen - pairs) / n - ridge * chain if with_chain else np.zeros((2, 2))
        g = np.concatenate([grad, turn.ravel()])
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        step = rate * (m / (1 - 0.9 ** k)) / (np.sqrt(v / (1 - 0.99 ** k)) + 1e-8)
        w, chain = w + step[:_WIDTH], chain + step[_WIDTH:].reshape(2, 2)
    return w, chain


def fit_lines(buckets: list[np.ndarray], sizes: list[np.ndarray], labels: np.ndarray) -> LineModel:
    """Fit on documents given by their lines' buckets and sizes and a 0/1 label."""
    labels = np.asarray(labels, dtype=float)
    lengths = np.array([len(b) for b in buckets], dtype=np.int64)
    if not lengths.sum() or labels.min() == labels.max():
        always = 20.0 if not len(labels) or labels.max() > 0 else -20.0
        return LineModel(np.zeros(_WIDTH), np.zeros((2, 2)), (always, 0.0))
    codes, size = _codes(np.concatenate(buckets), lengths), np.concatenate(sizes)
    doc = np.repeat(np.arange(len(lengths)), lengths)
    good = labels[doc]
    w, _ = _fit_chain(codes, lengths, good, with_chain=False)
    p = 1 / (1 + np.exp(-w[codes].sum(axis=1)))
    worst = np.full(len(lengths), np.inf)
    np.minimum.at(worst, doc, p)
    good = np.where((good == 0) & (p > 0.5) & (p > worst[doc]), 1.0, good)
    w, chain = _fit_chain(codes, lengths, good, with_chain=True)
    model = LineModel(w, chain, (0.0, 0.0))
    share = model._weigh(codes, lengths, size)
    a, b = 0.0, 0.0
    for _ in range(25):  # Newton steps for the curve, lightly penalised
        p = 1 / (1 + np.exp(-np.clip(a - b * share, -500, 500)))
        h = p * (1 - p) + 1e-6
        x = np.stack([np.ones_like(share), -share])
        step = np.linalg.solve((x * h) @ x.T + np.diag([1e-3, 1e-3]),
                               x @ (labels - p) - 1e-3 * np.array([a, b]))
        a, b = a + step[0], b + step[1]
    return LineModel(w, chain, (float(a), float(max(b, 0.0))))


def fit(docs: DataFrame, labels: DataFrame, keep=None, rows: int = SAMPLE) -> LineModel:
    """Fit on all lines of at most ``rows`` labelled documents.

    ``keep`` is a filter on the labels (a fold).  Of rows that repeat a doc_id one is
    used.  Without labels all texts score high.
    """
    def measured(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            both = [line_features(t) for t in b["text"]]
            yield pd.DataFrame({"doc_id": b["doc_id"], "label": b["label"],
                                "buckets": [x.tobytes() for x, _ in both],
                                "sizes": [s.tobytes() for _, s in both]})

    sample = labelled_sample(docs, labels, rows, keep)
    got = (one_row_each(sample.mapInPandas(measured, "doc_id long, label int, buckets binary, sizes binary"))
           .toPandas().sort_values("doc_id"))
    return fit_lines([np.frombuffer(b, dtype=np.uint8).reshape(-1, _N) for b in got["buckets"]],
                     [np.frombuffer(b, dtype=float) for b in got["sizes"]], got["label"].to_numpy())


def quality_score(text, model: LineModel):
    """Score column (0 to 1, higher: better) of whole texts; NULL counts as empty.

    A text without a word is taken to be bad throughout.
    """
    @F.pandas_udf("double")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            parts = [model.score(texts.iloc[k:k + 512]) for k in range(0, len(texts), 512)]
            yield pd.Series(np.concatenate(parts) if parts else np.empty(0))
    return of(text)


def classified(docs: DataFrame, labels: DataFrame, folds: int = 3, held: int = 1) -> DataFrame:
    """Per row of ``docs``: doc_id, held_out, score, predicted.

    A document is held out if crc32 of its doc_id's text leaves ``held`` modulo
    ``folds``; labels of held-out documents are not used.  A NULL doc_id is not
    held out.  Only the text enters a score.
    """
    fold = lambda c: F.coalesce(F.crc32(F.col(c).cast("string")) % folds == held, F.lit(False))
    model = fit(docs, labels, ~fold("doc_id"))
    return (docs.select("doc_id", fold("doc_id").alias("held_out"),
                        quality_score(F.col("text"), model).alias("score"))
            .withColumn("predicted", (F.col("score") >= 0.5).cast("int")))
