"""One thin query per operator: production parameters, whole tables, full results."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (attention_lm, chat, fingerprints, importance, licenses, line_crf, mixing, packing, periodic_runs,
               quality_rules, simhash, token_counts, token_files)
from .common import ship_package, table


def tokenizer_path(name: str) -> str:
    """Where a public tokenizer's file lies; the same on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (simhash.simhash_components(table(spark, sf_dir, "documents"), shingle=3, radius=2)
            .select("doc_id", "fingerprint", "component_id"))


def op2_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed_words(table(spark, sf_dir, "documents"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    trees = quality_rules.fit(docs, table(spark, sf_dir, "labels"))
    return quality_rules.judged(docs, trees, "rules").select(
        "doc_id", *[f"rules.{c}" for c in (*quality_rules.BASE, "base_failed", "kept", "score")])


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_matches(table(spark, sf_dir, "documents"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.field_tokens(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"),
                                     ("lang", "source", "text"))


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed_documents(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))


def op7_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = r"\### Assistant: </turn> ok"
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], rows.schema)
    path = tokenizer_path("byte_bpe_50k.json")
    return chat.conversation_digests(chat.formatted(rows.union(probe), path), path)


def op8_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edited_fingerprints(table(spark, sf_dir, "documents"))


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_files_round_trip(table(spark, sf_dir, "documents"),
                                              tokenizer_path("word_bpe_49k.json"), end_id=2)


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_crf.classified(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_attention_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return attention_lm.fold_scores(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"),
                                    end_id=50256)


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.run_digests(table(spark, sf_dir, "documents"))


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resampling_weights(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def _shipped(query: Callable) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return query(spark, sf_dir)
    run.__name__, run.__doc__ = query.__name__, query.__doc__
    return run


QUERIES = {q.__name__: _shipped(q) for q in (
    op1_simhash_near_dedup, op2_source_mixing, op3_quality_rules, op4_license_scan, op5_token_counts,
    op6_best_fit_packing, op7_chat_formatting, op8_document_fingerprints, op9_token_files,
    op10_quality_classifier, op11_attention_scores, op12_periodic_runs, op13_importance_resampling)}

ORACLES = {"op4_license_scan": licenses.oracle()}
