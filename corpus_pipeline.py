"""From documents to packed training sequences, in five stages.

Each stage is written as Parquet and read again as the next one's documents. What the stages decide: documents without a known
language go; one document of each group of near duplicates stays; documents that hold benchmark passages go; secrets are
replaced by a mark; what is left is packed into sequences.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from givingledger.llm import contamination, language, near_duplicates, packing, secrets
from givingledger.llm.common import small_batches, written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return language.accepted(docs)


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_duplicates.first_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return contamination.clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return secrets.redacted(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs)


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_id),
    ("jaccard_join", jaccard_join),
    ("decontamination", decontamination),
    ("secret_scans", secret_scans),
    ("best_fit_packing", best_fit_packing),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
