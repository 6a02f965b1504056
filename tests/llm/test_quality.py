import re
import zlib
from collections import Counter
from itertools import product

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfwise.llm import line_crf, quality_rules
from shelfwise.llm.labelled import labelled_sample, one_row_each

from .conftest import collected

SF = "/root/testdata/sf0.01"


def plain_base(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = Counter(zip(words, words[1:], words[2:]))
    again = [False] * len(words)
    for k, g in enumerate(zip(words, words[1:], words[2:])):
        if grams[g] > 1:
            again[k:k + 3] = [True] * 3
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return [len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
            len(lines) - len(set(lines)), sum(again)]


@pytest.mark.parametrize("text", [None, "", "a", "a b", "a a a a", "x y z x y z", "Ä # b\n\nÄ # b\n \n\t\n",
                                  "a b c d a b c\x0be\x1cf %$|", "\n".join(["same line here"] * 5)])
def test_base_statistics(text):
    assert quality_rules.statistics(text)[0] == plain_base(text)


def test_base_statistics_of_many_words():
    rng = np.random.default_rng(0)
    text = " ".join(f"w{k}" for k in rng.integers(0, 12, 3000))
    assert quality_rules.statistics(text)[0] == plain_base(text)


def test_trees_learn_and_stay_monotone():
    rng = np.random.default_rng(1)
    x = rng.random((3000, 2))
    y = ((x[:, 0] + 0.3 * np.sin(9 * x[:, 0]) < 0.6) ^ (rng.random(3000) < 0.05)).astype(float)
    trees = quality_rules.grow_trees(x, y, np.array([-1, 0]))
    assert ((trees.score(x) > 0.5) == (y > 0.5)).mean() > 0.85
    grid = np.linspace(-0.5, 1.5, 300)
    for other in (0.1, 0.5, 0.9):
        s = trees.score(np.stack([grid, np.full_like(grid, other)], axis=1))
        assert (np.diff(s) <= 1e-12).all()


def test_trees_of_one_class_or_none():
    x = np.zeros((4, 2))
    assert (quality_rules.grow_trees(x, np.ones(4), np.zeros(2)).score(x) > 0.99).all()
    assert (quality_rules.grow_trees(x[:0], np.ones(0), np.zeros(2)).score(x) == 0.5).all()


def test_rules_over_awkward_rows(awkward, clashing, nothing, labels, awkward_rows):
    trees = quality_rules.fit(awkward, labels)
    want = sorted(([r[0], *plain_base(r[1])] for r in awkward_rows), key=repr)
    for docs in (awkward, clashing):
        out = quality_rules.judged(docs, trees, "v")
        got = out.select("doc_id", *[f"v.{c}" for c in quality_rules.BASE]).collect()
        assert sorted((list(r) for r in got), key=repr) == want
    rows = quality_rules.judged(awkward, trees, "v").select("v.*").collect()
    for r in rows:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert r.kept == (not r.base_failed and r.score >= 0.5)
    assert quality_rules.judged(nothing, trees, "v").collect() == []
    assert (quality_rules.fit(nothing, labels.limit(0)).score(np.zeros((1, 12))) == 0.5).all()


def test_rules_find_labelled_quality(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    trees = quality_rules.fit(docs, labels)
    got = quality_rules.judged(docs, trees, "v").join(labels, "doc_id").select("v.score", "quality").collect()
    assert np.mean([(r.score >= 0.5) == (r.quality == 1) for r in got]) > 0.97


def test_labelled_sample_is_bounded(awkward, labels):
    assert labelled_sample(awkward, labels, 5).select("doc_id").distinct().count() <= 5
    assert labelled_sample(awkward, labels, 10 ** 6).where("doc_id IS NULL OR label IS NULL").count() == 0


def test_repeated_ids_stay_within_the_sample(spark, labels):
    rows = [(2, f"text {k}") for k in range(300)] + [(3, "other"), (3, "other")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = one_row_each(labelled_sample(docs, labels, 10 ** 6)).collect()
    assert sorted((r.doc_id, r.text) for r in got) == [(2, "text 0"), (3, "other")]
    assert np.isfinite(quality_rules.fit(docs, labels).score(np.zeros((1, len(quality_rules.FEATURES))))).all()
    assert np.isfinite(line_crf.fit(docs, labels).score(["text 1", ""])).all()


def test_marginals_equal_enumeration():
    rng = np.random.default_rng(4)
    lengths = np.array([3, 0, 5, 1])
    emission, chain = rng.normal(size=9), rng.normal(size=(2, 2))
    good, pairs, _ = line_crf.marginals(emission, lengths, chain)
    at, want, want_pairs = 0, [], np.zeros((2, 2))
    for n in lengths:
        weights = {}
        for y in product((0, 1), repeat=n):
            weights[y] = np.exp(sum(emission[at + i] * y[i] for i in range(n))
                                + sum(chain[y[i - 1], y[i]] for i in range(1, n)))
        total = sum(weights.values())
        want += [sum(w for y, w in weights.items() if y[i]) / total for i in range(n)]
        for y, w in weights.items():
            for i in range(1, n):
                want_pairs[y[i - 1], y[i]] += w / total
        at += n
    assert np.allclose(good, want) and np.allclose(pairs, want_pairs)


def test_line_features():
    buckets, size = line_crf.line_features("One line.\n\n  \nOne line.\nx | y")
    assert len(buckets) == 3 and size.tolist() == [9, 9, 5]
    assert buckets[0][9] == 0 and buckets[1][9] == 1
    assert len(line_crf.line_features(None)[0]) == len(line_crf.line_features("")[0]) == 0


def test_classifier_on_held_out_documents(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    got = line_crf.classified(docs, labels).join(labels, "doc_id").collect()
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
    held = [r for r in got if r.held_out]
    assert np.mean([r.predicted == r.quality for r in held]) > 0.95


def test_held_out_labels_are_not_used(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    held = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    turned = labels.withColumn("quality", F.when(held, 1 - F.col("quality")).otherwise(F.col("quality")))
    assert collected(line_crf.classified(docs, labels)) == collected(line_crf.classified(docs, turned))


def test_classifier_over_awkward_rows(awkward, clashing, nothing, labels, awkward_rows):
    for docs in (awkward, clashing):
        got = line_crf.classified(docs, labels)
        rows = got.collect()
        assert len(rows) == len(awkward_rows)
        assert all(r.score is not None and 0 <= r.score <= 1 for r in rows)
        assert not any(r.held_out for r in rows if r.doc_id is None)
    assert line_crf.classified(nothing, labels).collect() == []
    assert {r.predicted for r in line_crf.classified(awkward, labels.limit(0)).collect()} == {1}


def test_the_fit_sees_every_line(spark, monkeypatch):
    seen = []
    fitted = line_crf.fit_lines
    monkeypatch.setattr(line_crf, "fit_lines", lambda b, s, y: seen.extend(map(len, b)) or fitted(b, s, y))
    docs = spark.createDataFrame([(k, "\n".join(f"line {j}" for j in range(n))) for k, n in enumerate((3, 700))],
                                 "doc_id long, text string")
    line_crf.fit(docs, spark.createDataFrame([(0, 1, 0), (1, 0, 0)], "doc_id long, quality int, toxic int"))
    assert seen == [3, 700]
