"""Registered queries of this subpackage: ``(spark, data_dir) -> DataFrame``, and their DuckDB SQL.

Each query applies its operator to its whole table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faresight.llm import (bpe, exact_dedup, fingerprints, merkle, near_dedup, packing, passages, quality_rules, spelling,
                           token_counts, toxicity, url_filter, warc)
from faresight.llm.oracle import SQL  # noqa: F401

VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def _table(spark: SparkSession, data_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{data_dir.rstrip('/')}/{name}.parquet")


def _vocabulary() -> tuple[str, str]:
    """Path of the vocabulary and its pre-token pattern."""
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN


def op1_fingerprints(spark: SparkSession, data_dir: str) -> DataFrame:
    return fingerprints.compare_with_edits(spark, _table(spark, data_dir, "documents"))


def op2_token_counts(spark: SparkSession, data_dir: str) -> DataFrame:
    return token_counts.count_with_edits(
        spark, _table(spark, data_dir, "documents"), token_counts.sample_edits(), *_vocabulary())


def op3_substring_dedup(spark: SparkSession, data_dir: str) -> DataFrame:
    cleaned = passages.clean_passages(spark, _table(spark, data_dir, "documents").select("doc_id", "text"))
    return cleaned.select("doc_id", "text", F.length("text").cast("long").alias("n_chars"),
                          F.col("_spans").alias("removed_spans"), F.col("_removed").alias("removed_words"))


def op4_bpe(spark: SparkSession, data_dir: str) -> DataFrame:
    return bpe.round_trip(spark, _table(spark, data_dir, "documents"), *_vocabulary())


def op5_near_dedup(spark: SparkSession, data_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(spark, _table(spark, data_dir, "documents"))


def op6_quality_rules(spark: SparkSession, data_dir: str) -> DataFrame:
    return quality_rules.quality_verdicts(_table(spark, data_dir, "documents"))


def op7_url_filters(spark: SparkSession, data_dir: str) -> DataFrame:
    return url_filter.judge_urls(spark, _table(spark, data_dir, "pages"))


def op8_packing(spark: SparkSession, data_dir: str) -> DataFrame:
    return packing.pack(spark, _table(spark, data_dir, "documents"))


def op9_warc(spark: SparkSession, data_dir: str) -> DataFrame:
    return warc.archive_round_trip(spark, _table(spark, data_dir, "pages"))


def op10_toxicity(spark: SparkSession, data_dir: str) -> DataFrame:
    return toxicity.toxicity_scores(spark, _table(spark, data_dir, "documents"), _table(spark, data_dir, "labels"))


def op11_spelling(spark: SparkSession, data_dir: str) -> DataFrame:
    return spelling.spelling_variants(spark, _table(spark, data_dir, "documents"), misspell=spelling.drop_letter(31))


def op12_exact_dedup(spark: SparkSession, data_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(spark, _table(spark, data_dir, "documents"))


def op13_merkle_manifest(spark: SparkSession, data_dir: str) -> DataFrame:
    return merkle.tamper_report(spark, _table(spark, data_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_fingerprints, op2_token_counts, op3_substring_dedup, op4_bpe, op5_near_dedup, op6_quality_rules,
    op7_url_filters, op8_packing, op9_warc, op10_toxicity, op11_spelling, op12_exact_dedup, op13_merkle_manifest)}
