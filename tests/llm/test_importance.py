import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from shelfwise.llm import importance
from shelfwise.llm.queries import QUERIES

from .conftest import collected

SF = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_features(text):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return len(w), [" ".join(w[i:i + j]) for j in (1, 2, 3) for i in range(len(w) - j + 1)]


def plain(rows, target):
    """The whole contract with zlib and dictionaries."""
    bucket = lambda f: zlib.crc32(f.encode()) % 10_000
    found = [plain_features(r[1]) for r in rows]
    s = Counter(bucket(f) for _, fs in found for f in fs)
    t = Counter(bucket(f) for text in target for f in plain_features(text)[1])
    S, T = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1.0) * (S + 10_000.0) / ((s[b] + 1.0) * (T + 10_000.0))))
            for b in range(10_000)]
    out, able = [], []
    for k, (r, (n, fs)) in enumerate(zip(rows, found)):
        weight = sum(gain[bucket(f)] for f in fs)
        h = int(hashlib.sha256(f"42:{'' if r[0] is None else r[0]}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([r[0], len(fs), weight, score, None])
        if n >= 20:
            able.append((-score, (r[0] is not None, r[0] or 0), k))
    for place, (_, _, k) in enumerate(sorted(able)[:5 * len(able) // 100], 1):
        out[k][4] = place
    return sorted(map(tuple, out), key=repr)


def test_spans_of_all_lengths():
    rng = np.random.default_rng(0)
    raw = rng.integers(0, 256, 40_000).astype(np.uint8)
    n = np.concatenate([np.arange(1, 400), rng.integers(1, 20_000, 50)])
    start = rng.integers(0, 20_000, len(n))
    got = importance.span_crc32(raw, start, start + n)
    assert got.tolist() == [zlib.crc32(raw[a:a + k].tobytes()) for a, k in zip(start.tolist(), n.tolist())]


def test_whole_table_against_plain_python(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    target = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert collected(QUERIES["op13_importance_resampling"](spark, SF)) == plain(rows, target)


def test_awkward_rows(spark, awkward, clashing, nothing, awkward_rows):
    target = spark.createDataFrame([("lorem ipsum dolor sit am",), (None,), ("",)], "text string")
    texts = ["lorem ipsum dolor sit am", None, ""]
    want = plain(awkward_rows, texts)
    for docs in (awkward, clashing, awkward.repartition(7)):
        assert collected(importance.resampling_weights(docs, target)) == want
    assert importance.resampling_weights(nothing, target).collect() == []
    assert collected(importance.resampling_weights(awkward, target.limit(0))) == plain(awkward_rows, [])


def test_columns_are_kept_and_the_draw_is_the_top(clashing):
    docs = clashing.withColumn("rank", F.lit("own")).withColumn("importance", F.lit(1))
    out = importance.resampled(docs, docs.select("text"), percent=50, least_words=20)
    assert out.columns[:len(docs.columns)] == docs.columns
    rank, score, into = out.columns[-1], out.columns[-2], out.columns[-3]
    rows = out.select(F.col(into)["n_words"].alias("n"), F.col(score).alias("s"), F.col(rank).alias("r")).collect()
    able = [x for x in rows if x.n >= 20]
    drawn = sorted((x for x in able if x.r), key=lambda x: x.r)
    assert [x.r for x in drawn] == list(range(1, len(able) // 2 + 1))
    assert min(x.s for x in drawn) >= max(x.s for x in able if not x.r)
    assert not any(x.r for x in rows if x.n < 20)
