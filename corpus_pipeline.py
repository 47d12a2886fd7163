"""Corpus pipeline: each stage works on all documents that the one before it kept.

``STAGES`` lists ``(name, function)``; each function takes ``(spark, docs,
sf_dir)`` and returns a DataFrame that is written as Parquet and read again as
the next one's ``docs``.  All but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from rumbo.llm import mixing, packing, quality, simhash, toxicity
from rumbo.llm.common import store


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a quality score of at least 0.3 stay."""
    return quality.reject_low_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), threshold=0.3)


def toxicity_severity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose probability of any toxicity is below 0.5 stay."""
    return toxicity.reject_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), threshold=0.5)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of fingerprints within 4 bits stays."""
    return simhash.keep_one(docs, radius=4, words=4)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of the sources takes it (0 to 3 times)."""
    return mixing.mixed_documents(docs, weights=(5, 2, 1), max_epochs=3)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of the mixed documents in sequences of 4096."""
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality_rules", quality_rules),
    ("toxicity_severity", toxicity_severity),
    ("near_duplicates", near_duplicates),
    ("source_mix", source_mix),
    ("best_fit_packing", best_fit_packing),
]

# Trained scores, hashes and tokenizers are not expressible in SQL; see tests/llm for the checks.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
