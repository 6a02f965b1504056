"""A corpus pipeline of five stages over ``documents``.

Each stage takes (spark, docs, sf_dir), works on all rows of its predecessor
and returns the columns of ``documents``; the last one returns packed pieces.
Every stage's result is written as Parquet and read back as the next one's docs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.llm import line_crf, mixing, packing, quality_rules, simhash
from shelfwise.llm.common import fresh, ship_package, stored, table
from shelfwise.llm.queries import tokenizer_path


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts that the line classifier finds bad (score below 0.5) go."""
    ship_package(spark)
    model = line_crf.fit(docs, table(spark, sf_dir, "labels"))
    return docs.where(line_crf.quality_score(F.col("text"), model) >= 0.5)


def apply_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts that fail the base rules or that the trees reject go."""
    ship_package(spark)
    trees = quality_rules.fit(docs, table(spark, sf_dir, "labels"))
    [into] = fresh(docs, "_rules")
    return (quality_rules.judged(docs, trees, into).where(F.col(into)["kept"])
            .select(*docs.columns))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component stays: 3-word shingles, 2 bits."""
    ship_package(spark)
    return simhash.near_dedup(docs, shingle=3, radius=2)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them (0, 1 or 2 rows)."""
    return mixing.mixed(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 4096 tokens."""
    ship_package(spark)
    return packing.packed_documents(docs, tokenizer_path("word_bpe_49k.json"))


STAGES = [
    ("quality_classifier", classify),
    ("quality_rules", apply_rules),
    ("simhash_near_dedup", near_dedup),
    ("source_mixing", mix_sources),
    ("best_fit_packing", pack),
]

#: Models, hashes and tokens are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
