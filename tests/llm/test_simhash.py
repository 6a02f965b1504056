import numpy as np
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from shelfwise.llm import simhash

from .conftest import collected, prose


def plain_fingerprint(text):
    import re
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    grams = [" ".join(words[k:k + 3]) for k in range(max(1, len(words) - 2))]
    h = [xxhash.xxh64(g.encode(), seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(rows):
    fps = [plain_fingerprint(t) for _, t in rows]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= 2 and group[i] != group[j]:
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    least = {}
    for g, (i, _) in zip(group, rows):
        if i is not None:
            least[g] = min(least.get(g, i), i)
    return [(i, f"{f:016x}", least.get(g)) for (i, _), f, g in zip(rows, fps, group)]


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="aBc É\t\n\x1c\x0b", max_size=60))
def test_fingerprint_equals_its_definition(text):
    assert simhash.fingerprint(text) == plain_fingerprint(text)


def test_spark_hash_is_the_same(spark):
    got = spark.sql("SELECT hex(xxhash64('a b c'))").first()[0]
    assert int(got, 16) == xxhash.xxh64(b"a b c", seed=42).intdigest()


def test_components_equal_brute_force(awkward, clashing, awkward_rows):
    want = sorted(plain_components([r[:2] for r in awkward_rows]), key=repr)
    for docs in (awkward, clashing):
        assert collected(simhash.simhash_components(docs), "doc_id", "fingerprint", "component_id") == want


def test_links_survive_tiling(spark, monkeypatch):
    rng = np.random.default_rng(3)
    centres = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    near = [c ^ np.uint64(sum(1 << int(b) for b in rng.choice(64, k, replace=False)))
            for c in centres for k in (0, 1, 1, 2, 2, 3)]
    fps = np.unique(np.array(near, dtype=np.uint64))
    monkeypatch.setattr(simhash, "TILE", 4)
    nodes = spark.createDataFrame([(int(x),) for x in fps.view(np.int64)], "fp long")
    got = {r.node: r.root for r in simhash.components(simhash.links(nodes, 2)).collect()}
    far = np.bitwise_count(fps[:, None] ^ fps[None, :])
    label = np.arange(len(fps))
    for _ in range(len(fps)):
        label = np.array([label[row].min() for row in far <= 2])
    signed = fps.view(np.int64)
    groups = {}
    for x, g in zip(signed.tolist(), label.tolist()):
        groups.setdefault(g, set()).add(x)
    for members in groups.values():
        assert {got.get(m, m) for m in members} == {min(members)}


def test_forest_is_small():
    block = np.arange(2000, dtype=np.uint64) & np.uint64(3)
    u, v = simhash.link_tiles(np.unique(block), np.unique(block), 2)
    assert len(u) < 8


def test_near_dedup_keeps_one_row_of_each_component(awkward, clashing, awkward_rows):
    comps = plain_components([r[:2] for r in awkward_rows])
    for docs in (awkward, clashing):
        kept = simhash.near_dedup(docs)
        assert kept.columns == docs.columns
        ids = [r.doc_id for r in kept.collect()]
        assert sorted(i for i in ids if i is not None) == sorted({c for _, _, c in comps if c is not None})


def test_empty_table(nothing):
    assert simhash.simhash_components(nothing).collect() == []
    assert simhash.near_dedup(nothing).collect() == []


def test_a_chain_of_copies_is_one_component(spark):
    rows = [(k, prose(5, 60)) for k in range(50, 0, -1)]
    got = simhash.simhash_components(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r.component_id for r in got.collect()} == {1}
