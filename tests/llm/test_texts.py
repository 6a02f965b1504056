import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from shelfwise.llm import chat, fingerprints, licenses

from .conftest import collected, prose

SCHEMA = "conv_id long, turn long, role string, text string"


@pytest.fixture(scope="module")
def byte_bpe():
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.text(alphabet="usr<>\\\n ", max_size=6), st.text(alphabet="a<>/turn\\\n é", max_size=20)),
                max_size=5))
def test_rendering_is_reversible(turns):
    assert chat.parse(chat.render(turns)[0]) == turns


def awkward_turns():
    rows = [(1, k, "assistant" if k % 2 else "user", prose(k, 20)) for k in range(600)]  # several parts
    rows += [(2, 0, "assistant", None), (2, 1, None, "x"), (2, None, "system", "first"), (2, 1, "assistant", "\n</turn>")]
    rows += [(None, 0, "assistant", "no id \U0001f600\U0001f600"), (3, 0, "assistant", "<turn assistant>\n\\")]
    rows += [(4, 0, "assistant", "same"), (4, 0, "assistant", "same"), (5, -300, "user", "early"), (5, 3, "assistant", "")]
    rows += [(6, 0, "assistant", " lead and trail \n"), (6, 1, "assistant", "w" * 3000)]
    return rows


def plain_digests(rows):
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        convs[c].append((turn is not None, turn or 0, role is not None, role or "", text is not None, text or ""))
    out = []
    for c, turns in convs.items():
        turns = [(t[3], t[5]) for t in sorted(turns)]
        loss = "".join(t for r, t in turns if r == "assistant")
        said = "".join(f"{r}\n{t}\n" for r, t in turns)
        out.append((c, len(turns), hashlib.sha256(said.encode()).hexdigest(), len(loss),
                    hashlib.sha256(loss.encode()).hexdigest(), len(chat.render(turns)[0])))
    return sorted(out, key=repr)


def test_digests_equal_the_turns(spark, byte_bpe, monkeypatch):
    from pyspark.sql import functions as F
    rows = awkward_turns()
    want = plain_digests(rows)
    convs = spark.createDataFrame(rows, SCHEMA)
    for frame in (convs, convs.withColumns({"part": F.lit("x"), "sub": F.lit(1), "ids": F.lit(2)})):
        assert collected(chat.conversation_digests(chat.formatted(frame, byte_bpe), byte_bpe)) == want
    empty = chat.formatted(convs.limit(0), byte_bpe)
    assert empty.collect() == [] and chat.conversation_digests(empty, byte_bpe).collect() == []


def test_masks_cover_the_assistant_tokens(spark, byte_bpe):
    tok = chat._tokenizer(byte_bpe)
    for r in chat.formatted(spark.createDataFrame(awkward_turns(), SCHEMA), byte_bpe).collect():
        e = tok.encode(r.text, add_special_tokens=False)
        assert r.ids == e.ids
        spans = chat.render(chat.parse(r.text))[1]
        assert len(spans) == len(r.loss_first)
        for (a, b), lo, hi, lead, trail in zip(spans, r.loss_first, r.loss_last, r.loss_lead, r.loss_trail):
            inside = [k for k, (x, y) in enumerate(e.offsets) if y > a and x < b]
            assert inside == list(range(lo, hi)) or a == b
            if lo < hi:
                assert (e.offsets[lo][0] + lead, e.offsets[hi - 1][1] - trail) == (a, b)


def test_a_long_conversation_is_encoded_whole(spark, byte_bpe):
    rows = [(1, k, "assistant" if k % 2 else "user", prose(k % 50, 5 + k % 90) + " \n" * (k % 3)) for k in range(2000)]
    [row] = chat.formatted(spark.createDataFrame(rows, SCHEMA).repartition(7), byte_bpe).collect()
    text, _ = chat.render([(r[2], r[3]) for r in rows])
    assert row.n_turns == 2000 and row.text == text
    assert row.ids == chat._tokenizer(byte_bpe).encode(text, add_special_tokens=False).ids
    got = collected(chat.conversation_digests(spark.createDataFrame([row]), byte_bpe))
    assert got == plain_digests(rows)


@pytest.mark.parametrize("column", ["loss_first", "loss_last", "loss_lead", "loss_trail"])
def test_a_shifted_mask_changes_the_loss_digest(spark, byte_bpe, column):
    from pyspark.sql import functions as F
    convs = spark.createDataFrame([r for r in awkward_turns() if r[0] == 1], SCHEMA)
    done = chat.formatted(convs, byte_bpe)
    shifted = done.withColumn(column, F.transform(column, lambda x: x + 1))
    one, other = (chat.conversation_digests(x, byte_bpe).first() for x in (done, shifted))
    assert one.turns_sha256 == other.turns_sha256 and one.loss_sha256 != other.loss_sha256


def test_token_bytes_spell_every_text(byte_bpe):
    tok, pieces = chat._tokenizer(byte_bpe), chat.token_bytes(byte_bpe)
    for text in ("plain", " \t\n\x00\x7f\x80\xa0\xad\xff", "\U0001f600é日本 <|endoftext|>", prose(3, 200)):
        ids = tok.encode(text, add_special_tokens=False).ids
        assert b"".join(pieces[i] for i in ids).decode() == text


def test_multiset_hash_is_homomorphic():
    a, b = [prose(k, 30) for k in range(9)], [prose(k, 30) for k in range(20, 25)]
    whole = fingerprints.multiset_hash(a + b)
    rnd = random.Random(0)
    mixed = rnd.sample(a + b, len(a + b))
    same = lambda x, y: fingerprints.to_bytes(x) == fingerprints.to_bytes(y)
    assert same(whole, fingerprints.multiset_hash(mixed))
    assert same(whole, fingerprints.add(fingerprints.multiset_hash(a), fingerprints.multiset_hash(b)))
    assert same(fingerprints.multiset_hash(a), fingerprints.add(whole, fingerprints.multiset_hash(b), -1))
    assert not same(fingerprints.multiset_hash(a), fingerprints.multiset_hash(a + a[:1]))


def test_edited_fingerprints(spark, awkward, clashing, nothing, awkward_rows):
    order = sorted(awkward_rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    want = []
    for k, r in enumerate(order):
        text, after = r[1] or "", order[(k + 1) % len(order)][1] or ""
        n = len(text) // 4
        new = text[:len(text) - n] + after[:n]
        want.append((r[0], len(text), hashlib.sha256(new.encode()).hexdigest()))
    for docs in (awkward, clashing):
        got = fingerprints.edited_fingerprints(docs)
        assert collected(got, "doc_id", "n_chars", "edited_sha256") == sorted(want, key=repr)
        rows = got.collect()
        by_text = defaultdict(set)
        texts = {r[0]: r[1] or "" for r in awkward_rows}
        for r in rows:
            assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
            if r.doc_id is not None:
                by_text[texts[r.doc_id]].add(r.fingerprint)
        assert all(len(v) == 1 for v in by_text.values())
        assert len({f for v in by_text.values() for f in v}) == len(by_text)
        long = [r for r in rows if 20 <= (r.doc_id or 0) < 39]
        assert np.mean([r.near_edited for r in long]) > 0.5 > np.mean([r.near_next for r in long])
    assert fingerprints.edited_fingerprints(nothing).collect() == []
    one = fingerprints.edited_fingerprints(awkward.where("doc_id = 9")).collect()
    assert len(one) == 1 and one[0].near_next == 1.0


def test_likeness_comes_from_the_returned_fingerprints(spark, awkward, awkward_rows):
    """The fingerprints are the lanes: likeness, insertion and deletion work on what is returned."""
    lanes = lambda x: fingerprints.from_bytes(bytes.fromhex(x))
    order = sorted(awkward_rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    rows = sorted(fingerprints.edited_fingerprints(awkward).collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0))
    known = [r for r in rows if r.doc_id not in (None, 300)]  # ids of one row each
    texts = {r[0]: (r[1] or "", order[(k + 1) % len(order)][1] or "") for k, r in enumerate(order)}
    for r in known:
        text, after = texts[r.doc_id]
        own, other = lanes(r.fingerprint), lanes(r.edited_fingerprint)
        following = fingerprints.multiset_hash(fingerprints.paragraphs(after))
        assert r.near_edited == fingerprints.likeness(own[1], other[1])
        assert r.near_next == fingerprints.likeness(own[1], following[1])
        new = fingerprints.edited(text, after)
        for whole, got in ((text, own), (new, other)):
            assert fingerprints.to_bytes(fingerprints.multiset_hash(fingerprints.paragraphs(whole))) == \
                fingerprints.to_bytes(got)
        # delete the last paragraph from the returned fingerprint
        pieces = fingerprints.paragraphs(text)
        less = fingerprints.add(own, fingerprints.multiset_hash(pieces[-1:]), -1)
        assert fingerprints.to_bytes(less) == fingerprints.to_bytes(fingerprints.multiset_hash(pieces[:-1]))
    assert len(known) > 60


def test_each_text_is_hashed_once(monkeypatch, spark):
    pieces = [[f"p{k} some words" for k in range(n)] for n in (40, 10)]
    hashed = []
    plain = fingerprints.multiset_hash
    monkeypatch.setattr(fingerprints, "multiset_hash", lambda x: hashed.append(len(x)) or plain(x))
    h = plain(pieces[0])
    got = fingerprints.replaced(h, pieces[0], pieces[0][:30] + pieces[1])
    assert fingerprints.to_bytes(got) == fingerprints.to_bytes(plain(pieces[0][:30] + pieces[1]))
    assert hashed == [10, 10]


def test_every_range_of_ids_meets_its_successor(spark):
    rows = [(k * 3 - 500, f"text {k}") for k in range(400)] + [(None, "none")]
    random.Random(1).shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(9)
    got = fingerprints.with_next(docs, lambda t: t, lambda d, t, n: (d, t, n), "doc_id long, text string, after string", 5)
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    want = [(i, t, order[(k + 1) % len(order)][1]) for k, (i, t) in enumerate(order)]
    assert collected(got) == sorted(want, key=repr)


def plain_matches(rows, threshold=licenses.THRESHOLD):
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        units = ([(0, text)] if len(lines) > 1 else []) + list(enumerate(lines, 1))
        for n, unit in units if text is not None else []:
            own = set(licenses._bigrams(unit))
            for name, body in licenses.TEMPLATES.items():
                other = set(licenses._bigrams(body))
                dice = 2 * len(own & other) / (len(own) + len(other))
                if dice >= threshold:
                    out.append((i, n, name, len(own), len(own & other), dice))
    return sorted(out, key=repr)


def test_license_matches_equal_brute_force(spark, awkward, clashing, nothing, awkward_rows):
    mit, gpl = licenses.TEMPLATES["MIT"], licenses.TEMPLATES["GPL-3.0-notice"]
    rows = [r[:2] for r in awkward_rows] + [
        (400, mit), (401, f"text\n{mit.upper()}\n\nmore"), (402, gpl.replace(" and ", "\nand ")),
        (403, gpl.replace("warranty", "")), (404, mit + " " + mit), (405, "Released under the mit"),
        (406, None), (407, mit), (407, mit), (None, mit)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = plain_matches(rows)
    assert {400, 401, 402, 404, 407, None} <= {w[0] for w in want}
    assert collected(licenses.license_matches(docs)) == want
    assert collected(licenses.license_matches(clashing)) == plain_matches([r[:2] for r in awkward_rows])
    assert licenses.license_matches(nothing).collect() == []


def test_size_bounds_lose_no_match():
    for n in range(1, 60):
        for size in range(1, 120):
            most = 2 * min(n, size) / (n + size)
            assert most < 0.8 or size in licenses.admissible(n, 0.8)


def test_no_python_on_the_native_paths(spark, awkward):
    from shelfwise.llm import mixing
    for frame in (licenses.license_matches(awkward), mixing.mixed_words(awkward), mixing.mixed(awkward)):
        plan = frame._jdf.queryExecution().toString()
        assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def test_license_matches_equal_the_sql(spark, duck):
    from tests.helpers import digest

    from shelfwise.llm.queries import ORACLES, QUERIES
    df = QUERIES["op4_license_scan"](spark, "/root/testdata/sf0.01")
    rows = [tuple(r) for r in df.collect()]
    res = duck.execute(ORACLES["op4_license_scan"])
    assert rows and digest(df.columns, rows) == digest([d[0] for d in res.description], res.fetchall())


def wrapped(text, words=10):
    said = text.split()
    return "\n".join(" * " + " ".join(said[k:k + words]) for k in range(0, len(said), words))


def test_license_passages_inside_longer_texts(spark):
    mit, gpl = licenses.TEMPLATES["MIT"], licenses.TEMPLATES["GPL-3.0-notice"]
    long = prose(5, 2000)
    rows = [(1, f"{long}\n{wrapped(gpl)}\n{long}"), (2, f"This project was written in a week for fun. {mit}"),
            (3, f"{long}\nFun. {wrapped(gpl)}\n{long}\n{mit} {long}\n{mit}"), (4, long), (5, f"{long}\n{mit}")]
    got = licenses.license_matches(spark.createDataFrame(rows, "doc_id long, text string"))
    n, size, small = long.count("\n") + 1, len(licenses._bigrams(gpl)), len(licenses._bigrams(mit))
    after = n + 1 + gpl.count(" ") // 10 + 1 + n
    assert [r for r in collected(got) if r[2] in ("MIT", "GPL-3.0-notice")] == sorted([
        (1, -(n + 1), "GPL-3.0-notice", size, size, 1.0), (2, -1, "MIT", small, small, 1.0),
        (3, -(n + 1), "GPL-3.0-notice", size, size, 1.0), (3, -after, "MIT", small, small, 1.0),
        (3, after + n, "MIT", small, small, 1.0), (5, n + 1, "MIT", small, small, 1.0)], key=repr)


def test_every_match_holds_a_mark_and_enough_bigrams():
    owns = {k: licenses._bigrams(v) for k, v in licenses.TEMPLATES.items()}
    marks = set(licenses.marks(list(owns.values()), licenses.THRESHOLD))
    for own in owns.values():
        need = licenses.needed(len(own), licenses.THRESHOLD)
        assert sum(not marks & set(g.split()) for g in own) < need
    for n in range(1, 300):
        need = licenses.needed(n, 0.8)
        assert 2.0 * need / (need + n) >= 0.8 and 2.0 * (need - 1) / (need - 1 + n) < 0.8


def test_license_texts_are_found(spark):
    t = licenses.TEMPLATES
    rows = [(1, f"{prose(5, 500)}\nMIT License\n\nCopyright (c) 2020 A. Person\n\n{wrapped(t['MIT-text'])}\n{prose(6, 500)}"),
            (2, f"{prose(7, 300)}\n{wrapped(t['MIT-permission'])}"), (3, wrapped(t["BSD-3-Clause-conditions"], 12)),
            (4, f"{wrapped(t['Apache-2.0-notice'], 9)}\n{prose(8, 900)}"),
            (5, f"{prose(9, 300)}\n{wrapped(t['ISC-text'])}"), (6, prose(5, 500))]
    got = licenses.license_matches(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    sure = {(r.doc_id, r.license_id) for r in got if r.dice > 0.95}
    assert {(1, "MIT-title"), (1, "MIT-text"), (1, "MIT-permission"), (2, "MIT-permission"),
            (3, "BSD-3-Clause-conditions"), (4, "Apache-2.0-notice"), (5, "ISC-text")} <= sure
    assert 6 not in {r.doc_id for r in got}


def near(a, b):
    return fingerprints.likeness(*(fingerprints.multiset_hash(fingerprints.paragraphs(t))[1] for t in (a, b)))


def test_each_edited_text_stays_near():
    others = [prose(100 + k, 2000) for k in range(8)]
    texts = ["a short text", "one piece of a few words", prose(1, 11), "x" * 30]                 # single pieces
    texts += [prose(2, 60) + "\n" + "the same line again and again\n" * 70,                       # one line repeated
              "the same line again and again\n" * 70 + prose(3, 300), "\n" * 200 + prose(4, 100)]
    texts += [prose(5 + k, 5 + 40 * k) for k in range(30)]
    for text in texts:
        for after in others:
            assert near(text, fingerprints.edited(text, after)) > 0.4
            assert near(text, after) < 0.4


def test_likeness_of_very_long_repetitive_texts():
    line = "the same line again\n"
    assert near(line * 40_000, line * 30_000) == pytest.approx(0.96, abs=0.01)
    assert near(line * 100_000, line * 100_000) == near("\n" * 32_768, "\n" * 32_768) == 1.0
    assert near("\n" * 40_000, "\n" * 30_000) == pytest.approx(0.96, abs=0.01)
    text = "\n" * 65_536 + prose(1, 500)
    assert near(text, "\n" * 32_768 + prose(1, 500)) > 0.9
