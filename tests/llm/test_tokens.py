import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from shelfwise.llm import packing, token_counts, token_files
from shelfwise.llm.tokenizing import WordEncoder
from shelfwise.session import new_scratch

from .conftest import collected, prose

ODD = ["", " ", "Å b", "ΑΣ Σ", "x\x1cy z", "it's DON'T l'été\xa0Ünd\x85ß ẞ İ", "<|endoftext|> Hi.",
       "a  b\t\tc\n\n..!? 12a3. word.", "日本語 テキスト。", "é ́x", "µm ª º ÷ ×", "it's. a.b., c!.", "Å Ω."]


@pytest.fixture(scope="module")
def encoder(word_bpe):
    return WordEncoder(word_bpe, most=500)


def test_word_wise_ids_and_spans_equal_the_library(encoder):
    texts = ODD + [prose(k, 200) for k in range(30)]
    want = encoder.tokenizer.encode_batch(texts, add_special_tokens=False)
    assert [np.frombuffer(x, "<u4").tolist() for x in encoder.ids(texts)] == [e.ids for e in want]
    assert [list(zip(a.tolist(), b.tolist())) for a, b in encoder.token_spans(texts)] == [e.offsets for e in want]
    assert list(encoder.ids([None])) == [b""]


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.sampled_from("aB.,!?'sé ÉΣİßſ1²\t\n\x1c\x85\xa0 ́日<|>"), max_size=40))
def test_ids_equal_the_library(word_bpe, text):
    global _one
    _one = globals().get("_one") or WordEncoder(word_bpe)
    e = _one.tokenizer.encode(text, add_special_tokens=False)
    assert np.frombuffer(next(_one.ids([text])), "<u4").tolist() == e.ids
    a, b = next(_one.token_spans([text]))
    assert list(zip(a.tolist(), b.tolist())) == e.offsets


@pytest.mark.parametrize("rule", token_counts.RULES)
def test_allocation_equals_brute_force(rule):
    rnd = random.Random(rule)
    for _ in range(200):
        edges = sorted(rnd.sample(range(60), 2 * rnd.randint(0, 12)))
        starts, ends = np.array(edges[::2], dtype=np.int64), np.array(edges[1::2], dtype=np.int64)
        sections = np.array([0, *sorted(rnd.sample(range(1, 60), rnd.randint(0, 6)))])
        want, cross = np.zeros(len(sections)), np.zeros(len(sections))
        for a, b in zip(starts, ends):
            of = [int((sections <= c).sum()) - 1 for c in range(a, b)]
            cross[of[0]] += len(set(of)) > 1
            if rule == "split":
                for s in of:
                    want[s] += 1 / len(of)
            else:
                want[of[0] if rule == "start" else max(sorted(set(of)), key=of.count)] += 1
        got, crossing = token_counts.allocate(starts, ends, sections, rule)
        assert np.allclose(got, want) and (crossing == cross).all()


@pytest.mark.parametrize("sections", [token_counts.paragraphs, token_counts.even_sections])
def test_field_tokens_add_up(awkward, clashing, nothing, awkward_rows, word_bpe, encoder, sections):
    fields = ("source", "text")
    for docs in (awkward, clashing):
        rows = token_counts.field_tokens(docs, word_bpe, fields, sections).collect()
        total = defaultdict(float)
        for r in rows:
            total[r.doc_id, r.field] += r.n_tokens
        want = defaultdict(int)
        for r in awkward_rows:
            for field, value in zip(fields, (r[3], r[1])):  # a line end parts the fields: no token crosses it
                want[r[0], field] += len(encoder.tokenizer.encode(value or "", add_special_tokens=False).ids)
        assert total == want
        assert sum(r.n_chars for r in rows if r.field == "text") == sum(len(r[1] or "") for r in awkward_rows)
    assert token_counts.field_tokens(nothing, word_bpe).collect() == []
    with pytest.raises(ValueError):
        token_counts.field_tokens(nothing, word_bpe, rule="any")


def test_paragraphs_hold_their_own_lines(spark, word_bpe, encoder):
    text = "# Heading one\n\nfirst paragraph here\n\n\nsecond one.\nthird\n"
    docs = spark.createDataFrame([(1, "en", text)], "doc_id long, lang string, text string")
    rows = token_counts.field_tokens(docs, word_bpe, ("lang", "text")).collect()
    parts = {(r.field, r.section): (("en" if r.field == "lang" else text)[r.start:r.start + r.n_chars], r.n_tokens) for r in rows}
    assert [p[0] for k, p in sorted(parts.items()) if k[0] == "text"] == [
        "# Heading one\n\n", "first paragraph here\n\n\n", "second one.\n", "third\n"]
    for said, n in parts.values():
        assert n == len(encoder.tokenizer.encode(said, add_special_tokens=False).ids)


def test_a_tokenizer_that_keeps_white_space_encodes_whole_texts(spark, awkward):
    """byte_bpe joins white space to words: ids and spans must still be those of the library."""
    import public_tokenizers
    path = public_tokenizers.path("byte_bpe_50k.json")
    enc = WordEncoder(path)
    assert not enc.word_wise and WordEncoder(public_tokenizers.path("word_bpe_49k.json")).word_wise
    texts = ODD + [prose(k, 100) for k in range(5)]
    want = enc.tokenizer.encode_batch(texts, add_special_tokens=False)
    assert [np.frombuffer(x, "<u4").tolist() for x in enc.ids(texts)] == [e.ids for e in want]
    assert [list(zip(a.tolist(), b.tolist())) for a, b in enc.token_spans(texts)] == [e.offsets for e in want]
    crossing = 0
    for r in token_counts.field_tokens(awkward, path, ("source", "text"), token_counts.even_sections, "split").collect():
        crossing += r.n_crossing
    assert crossing > 0


def unpack(plan):
    """Sequences of a plan as lists of (offset, length)."""
    out = defaultdict(list)
    for length, runs in plan.runs.items():
        for count, each, first, offset in runs:
            for k in range(count):
                out[first + k // each].append((offset + k % each * length, length))
    return [sorted(v) for v in out.values()]


def least_sequences(items, capacity):
    """The smallest number of sequences, by exhaustive search."""
    items, best = sorted(items, reverse=True), [len(items)]

    def place(k, bins):
        if len(bins) >= best[0]:
            return
        if k == len(items):
            best[0] = len(bins)
            return
        for b in {x: i for i, x in enumerate(bins) if x >= items[k]}.values():
            bins[b] -= items[k]
            place(k + 1, bins)
            bins[b] += items[k]
        place(k + 1, bins + [capacity - items[k]])

    place(0, [])
    return best[0]


@settings(max_examples=120, deadline=None)
@given(st.lists(st.integers(1, 20), max_size=9))
def test_reduction_loses_no_sequence(items):
    counts, plan = np.bincount(items, minlength=21).astype(np.int64), packing.Plan()
    packing.reduce_dominated(counts, 20, plan)
    rest = [n for n, c in enumerate(counts) for _ in range(int(c))]
    assert plan.sequences + least_sequences(rest, 20) == least_sequences(items, 20)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 64), max_size=200))
def test_plans_hold_every_piece_without_gaps(items):
    plan = packing.plan_sequences(np.bincount(items, minlength=65), 64)
    placed = []
    for seq in unpack(plan):
        at = 0
        for offset, length in seq:
            assert offset == at
            at += length
        assert at <= 64
        placed += [length for _, length in seq]
    assert sorted(placed) == sorted(items)
    assert plan.sequences == len(unpack(plan)) or not items


def test_packed_documents(awkward, clashing, nothing, awkward_rows, word_bpe, encoder):
    for docs in (awkward, clashing):
        rows = packing.packed_documents(docs, word_bpe, with_ids=True).collect()
        assert len(rows) > len(awkward_rows)  # the long text is cut
        seqs, texts = defaultdict(list), defaultdict(list)
        for r in rows:
            seqs[r.sequence_id].append((r.offset, r.length))
            assert len(r.ids) == 4 * r.length and zlib.crc32(r.ids) == r.ids_crc32
            if r.doc_id not in (None, 300):
                texts[r.doc_id].append((r.start, np.frombuffer(r.ids, "<u4").tolist()))
        for parts in seqs.values():
            at = 0
            for offset, length in sorted(parts):
                assert offset == at
                at += length
            assert at <= 4096
        for i, text, *_ in awkward_rows:
            if i not in (None, 300):
                want = encoder.tokenizer.encode(text or "", add_special_tokens=False).ids + [1]
                assert [x for _, p in sorted(texts[i]) for x in p] == want
        total = sum(r.length for r in rows)
        assert len(seqs) <= -(-total // 4096) + 1
    assert packing.packed_documents(nothing, word_bpe).collect() == []


def test_hash_is_minimal_and_perfect():
    rng = np.random.default_rng(5)
    for n in (0, 1, 2, 5000):
        h1, h2 = (rng.integers(0, 1 << 63, n, dtype=np.uint64) for _ in range(2))
        levels, slots = token_files.build_hash(h1, h2)
        assert sorted(slots.tolist()) == list(range(n))
        assert (token_files.look_up(levels, h1, h2) == slots).all()
    with pytest.raises(ValueError):
        token_files.build_hash(np.ones(2, np.uint64), np.ones(2, np.uint64))


def test_token_files_round_trip(awkward, clashing, nothing, awkward_rows, word_bpe, encoder, monkeypatch):
    monkeypatch.setattr(token_files, "ROWS_PER_SHARD", 7)
    coded = sorted(((r[0] is not None, r[0] or 0, np.array(
        encoder.tokenizer.encode(r[1] or "", add_special_tokens=False).ids + [2], "<u2").tobytes())
        for r in awkward_rows))
    want, at = [], 0
    for known, i, ids in coded:
        n = len(ids) // 2
        want.append((i if known else None, at, n, zlib.crc32(np.frombuffer(ids, "<u2").astype("<u4").tobytes())))
        at += n
    for docs in (awkward, clashing):
        assert collected(token_files.token_files_round_trip(docs, word_bpe)) == sorted(want, key=repr)
    assert token_files.token_files_round_trip(nothing, word_bpe).collect() == []


def test_unknown_keys_are_not_found(spark, awkward, word_bpe):
    entries = token_files.write_token_files(awkward, word_bpe, 2, new_scratch(spark, "test_files"))
    index, buckets = token_files.build_index(entries)
    asked = spark.createDataFrame([(k, 0) for k in range(5000, 5400)] + [(300, 1), (300, 2)],
                                  "doc_id long, ordinal int")
    got = token_files.locate(asked, index, buckets).collect()
    assert len(got) == 402 and sum(r.shard >= 0 for r in got) == 1


def test_more_shards_than_the_step_allows_for(spark, word_bpe, monkeypatch):
    from shelfwise.llm import common
    for module in (common, token_files):
        monkeypatch.setattr(module, "MAX_SHARDS", 2, raising=False)
    monkeypatch.setattr(token_files, "ROWS_PER_SHARD", 1)
    monkeypatch.setattr(token_files, "shard_bounds", lambda *_: list(range(0, 40, 8)))  # of five range partitions
    docs = spark.createDataFrame([(k, f"text {k}") for k in range(40)], "doc_id long, text string")
    got = token_files.token_files_round_trip(docs, word_bpe).select("doc_id").collect()
    assert sorted(r.doc_id for r in got) == list(range(40))
