from collections import Counter

import pytest

import __spark_entry__ as entry
import corpus_pipeline as pipeline
from shelfwise.llm import line_crf, quality_rules, simhash

SF = "/root/testdata/sf0.001"


def test_stages():
    assert [n for n, _ in pipeline.STAGES] == ["quality_classifier", "quality_rules", "simhash_near_dedup",
                                               "source_mixing", "best_fit_packing"]


def test_registered():
    names = set(entry.queries())
    assert "pipeline" in names
    assert {n.split("_")[0] for n in names if n.startswith("op")} == {f"op{k}" for k in range(1, 14)}
    assert set(entry.oracle_sql()) <= names


def test_every_stage_takes_awkward_rows(spark, clashing, nothing, tmp_path):
    from .conftest import collected
    for docs in (clashing, nothing):
        for name, stage in pipeline.STAGES:
            path = str(tmp_path / f"{name}-{docs.count()}-{len(docs.columns)}")
            out = stage(spark, docs, SF)
            out.write.parquet(path)
            if name != "best_fit_packing":
                assert out.columns == docs.columns
                assert spark.read.parquet(path).count() <= 2 * docs.count()


def test_decisions_take_effect(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = {r.doc_id: r for r in docs.collect()}
    model = line_crf.fit(docs, labels)
    good = {i for i, r in rows.items() if model.score([r.text])[0] >= 0.5}
    first = pipeline.classify(spark, docs, SF)
    assert {r.doc_id for r in first.collect()} == good
    second = pipeline.apply_rules(spark, first, SF)
    trees = quality_rules.fit(first, labels)
    import numpy as np
    kept = set()
    for i in good:
        base, x = quality_rules.statistics(rows[i].text)
        if base[0] >= 50 and 100 * base[4] <= 50 * base[0] and trees.score(np.array([x]))[0] >= 0.5:
            kept.add(i)
    assert {r.doc_id for r in second.collect()} == kept
    fps = {i: simhash.fingerprint(rows[i].text) for i in kept}
    third = pipeline.near_dedup(spark, second, SF)
    left = {r.doc_id for r in third.collect()}
    group = {i: i for i in kept}
    for a in sorted(kept):
        for b in sorted(kept):
            if a < b and bin(fps[a] ^ fps[b]).count("1") <= 2 and group[a] != group[b]:
                low, high = sorted((group[a], group[b]))
                group = {k: low if g == high else g for k, g in group.items()}
    assert left == set(group.values())
    fourth = pipeline.mix_sources(spark, third, SF)
    copies = Counter(r.doc_id for r in fourth.collect())
    assert set(copies) <= left and max(copies.values()) <= 2
    packed = pipeline.pack(spark, fourth, SF).collect()
    assert Counter(r.doc_id for r in packed if r.piece == 0) == copies


def test_whole_pipeline(spark):
    out = pipeline.run(spark, SF)
    rows = out.collect()
    assert rows and {"doc_id", "piece", "length", "sequence_id", "offset"} <= set(out.columns)
    assert max(r.offset + r.length for r in rows) <= 4096
