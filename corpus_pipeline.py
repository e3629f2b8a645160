"""Corpus preparation: filter, deduplicate and pack documents in stages.

Each stage takes ``(spark, docs, sf_dir)`` and works on all documents that the
stage before it kept.  Every stage's result is written as Parquet under the
shared checkpoint folder and read again, so a lost executor or a failed later
stage repeats one stage only.  All stages but the last return the columns of
``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from faresight.llm import near_dedup, packing, passages, quality_rules, toxicity
from faresight.session import scratch_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go; boilerplate lines leave the others' texts."""
    return quality_rules.apply_quality_rules(docs)


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored 0.5 or more go; the model learns from ``labels``."""
    return toxicity.drop_toxic(spark, docs, spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet"))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return near_dedup.near_dedup(spark, docs)


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that a document with a smaller doc_id has too leave the texts."""
    return passages.dedup_passages(spark, docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents, in pieces if long, are dealt to batches of length buckets."""
    return packing.pack(spark, docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_stage),
    ("toxicity", toxicity_stage),
    ("near_dedup", near_dedup_stage),
    ("substring_dedup", substring_stage),
    ("packing", packing_stage),
]

# Boosted trees, MinHash clusters and the bucket bounds have no SQL form; the
# tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents`` of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs


QUERIES = {"pipeline": run}
SQL: dict[str, str] = {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
