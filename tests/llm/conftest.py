import random

import pytest

from shelfwise.llm.common import ship_package

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    ship_package(spark)


@pytest.fixture(scope="session")
def word_bpe():
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def prose(seed: int, words: int) -> str:
    rnd = random.Random(seed)
    syllables = ["lo", "rem", "ip", "sum", "do", "lor", "sit", "am", "et", "con", "sec", "te"]
    said = ["".join(rnd.choices(syllables, k=rnd.randint(1, 4))) for _ in range(words)]
    lines = [" ".join(said[k:k + 12]).capitalize() + "." for k in range(0, words, 12)]
    return "\n".join(lines)


@pytest.fixture(scope="session")
def awkward_rows():
    """NULLs everywhere, empty and long texts, ties, repeated rows."""
    long_text = prose(1, 20_000)
    rows = [(k, prose(k, 30 + 7 * k), "en", f"s{k % 4}", None) for k in range(2, 40)]
    rows += [(100 + k, prose(2, 44), "en", "s0", 1) for k in range(20)]          # copies, a hot source
    rows += [(130, prose(2, 44) + " one more", "de", None, 2)]
    rows += [(200, None, None, None, None), (201, "", "en", "s1", 0), (202, " \t\n", "en", "s1", 3),
             (203, long_text, "en", "s2", len(long_text)), (204, "one", None, "s9", 3),
             (205, "Ünïcode ʘ 日本 <turn> \\ <|endoftext|> x\x1cy", "en", "s2", 5),
             (None, "no id at all, but some words", "en", "s1", 9), (None, None, None, None, None)]
    rows += [(300, "the same row twice", "en", "s3", 7)] * 2
    return rows


@pytest.fixture(scope="session")
def awkward(spark, awkward_rows):
    return spark.createDataFrame(awkward_rows, SCHEMA)


@pytest.fixture(scope="session")
def clashing(awkward):
    """The same rows with columns named like the operators' own ones."""
    from pyspark.sql import functions as F
    names = ["fp", "size", "piece", "start", "length", "offset", "sequence_id", "label", "score", "units",
             "h", "id", "code", "shard", "ids", "_hash", "_id", "_rules", "_h", "_copies", "unit", "own",
             "target", "fingerprint", "component_id", "held_out", "predicted", "ordinal", "at"]
    return awkward.withColumns({n: F.lit("x") for n in names})


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def labels(spark, awkward_rows):
    rows = [(r[0], int(k % 3 > 0), 0) for k, r in enumerate(awkward_rows)] + [(9999, None, None)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def collected(df, *cols):
    return sorted((tuple(r) for r in (df.select(*cols) if cols else df).collect()), key=repr)
