"""The corpus pipeline: documents -> quality rules -> one of each near-copy group -> benchmark leaks out
-> secrets masked -> packed training sequences.

Each stage is a function (spark, docs, sf_dir) -> DataFrame over all that its predecessor kept; its
result is written as Parquet and read again as the next one's ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tripstar.llm import decontaminate, packing, quality, registry, secrets, simhash
from tripstar.llm.common import materialise, table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the trusted-to-raw likelihood ratio keep."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-copies: the one with the smallest id."""
    return simhash.keep_one(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item is found."""
    return decontaminate.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with the secrets in their texts masked."""
    return secrets.mask_secrets(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of full training sequences, mixed by source."""
    return packing.pack(docs, registry.TOKENIZER)


STAGES = [
    ("quality_rules", quality_stage),
    ("simhash_near_dedup", near_duplicate_stage),
    ("benchmark_decontamination", decontamination_stage),
    ("secret_scans", secret_stage),
    ("packing", packing_stage),
]

# Hashed weights, connected components and a tokenizer are beyond SQL; the tests hold the stages
# against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of the last stage over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = materialise(docs, f"stage-{name}")
    return docs
