from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from shelfwise.llm import mixing

from .conftest import collected, prose


def plain_targets(sizes, weights=(5, 2, 1), share=1.5, most=2.0):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    capped, total = set(), share * sum(sizes.values())
    while True:
        rest = [s for s in order if s not in capped]
        room = total - sum(most * sizes[s] for s in capped)
        target = {s: room * weight[s] / sum(weight[r] for r in rest) for s in rest}
        above = [s for s in rest if target[s] > most * sizes[s]]
        if not above:
            return target | {s: most * sizes[s] for s in capped}
        capped |= set(above)


def test_targets_and_bounds(awkward, clashing, awkward_rows):
    sizes = defaultdict(int)
    for r in awkward_rows:
        sizes[r[3]] += len((r[1] or "").encode().split())
    want = plain_targets(sizes)
    for docs in (awkward, clashing):
        rows = mixing.mixed_words(docs).collect()
        assert len(rows) == len(awkward_rows)
        source = {r[0]: r[3] for r in awkward_rows}
        for r in rows:
            if r.doc_id is not None:
                assert r.source_size == sizes[source[r.doc_id]]
                assert r.target == pytest.approx(want[source[r.doc_id]])
            assert r.copies in (0, 1, 2) and r.taken == r.copies * r["size"]


def test_taken_words_come_near_targets_across_levels(spark, monkeypatch):
    monkeypatch.setattr(mixing, "FAN", 8)  # several levels of the tree
    rows = [(k, prose(k, 20 + k % 60), "hot" if k % 3 else f"s{k % 5}") for k in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mixed_words(docs).join(docs.select("doc_id", "source"), "doc_id")
    per = got.groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target"),
                                    F.max("size").alias("most")).collect()
    assert len(per) == 6
    for r in per:
        assert abs(r.taken - r.target) <= r.most


def test_sources_of_fifty_texts_come_within_a_percent(spark):
    """Also beside a text that is a fifth of its source."""
    rows = []
    for s in range(8):
        for k in range(50):
            n = 20 + (37 * k + 11 * s) % 120
            rows.append((100 * s + k, "w " * (1500 if k == 7 and s % 2 else n), f"s{s}"))
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mixed_words(docs).join(docs.select("doc_id", "source"), "doc_id")
    per = got.groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target")).collect()
    assert len(per) == 8
    for r in per:
        assert abs(r.taken - r.target) <= 0.01 * r.target
    assert all(r.taken <= 2 * r["size"] for r in got.collect())


def test_reruns_agree(awkward):
    cols = ("doc_id", "size", "copies")
    assert collected(mixing.mixed_words(awkward), *cols) == collected(
        mixing.mixed_words(awkward.repartition(7)), *cols)


def test_rounding_keeps_expectations(spark):
    rows = [(k, "w " * 10, "a", None) for k in range(400)] + [(1000 + k, "w " * 10, "b", None) for k in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars long")
    got = mixing.mixed_words(docs, weights=(1, 3), share=1.0).collect()
    for low, wanted in ((0, 0.5), (1000, 1.5)):
        copies = [r.copies for r in got if low <= r.doc_id < low + 400]
        assert abs(sum(copies) / 400 - wanted) < 0.01  # the sum is kept
        first = sum(copies[:200]) / 200
        assert abs(first - wanted) < 0.25              # and no half is favoured


def test_mixed_repeats_whole_rows(clashing, nothing):
    decided = {(r.doc_id, r["size"]): r.copies for r in mixing.mixed_words(clashing).collect()
               if r.doc_id is not None}
    out = mixing.mixed(clashing)
    assert out.columns == clashing.columns
    got = defaultdict(int)
    for r in out.collect():
        if r.doc_id is not None:
            got[r.doc_id] += 1
    twice = {300: 2}
    assert got == {k[0]: v * twice.get(k[0], 1) for k, v in decided.items() if v}
    assert mixing.mixed(nothing).collect() == [] and mixing.mixed_words(nothing).collect() == []
