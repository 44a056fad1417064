"""Queries opN_<name> over the sample tables, with production parameters, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from givingledger.llm import (contamination, conversations, fingerprints, html_text, language, licenses, near_duplicates, packing,
                              periodic_runs, quality, secrets, token_files, url_filters)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def vocabulary_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(table(spark, folder, "documents"))


def op2_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return contamination.report(table(spark, folder, "documents"), table(spark, folder, "benchmark")).drop("doc")


def op3_secret_scans(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.report(table(spark, folder, "documents"))


def op4_license_scans(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scan(table(spark, folder, "documents"))


def op5_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return language.identify(table(spark, folder, "documents"))


def op6_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages")
    return url_filters.judge(pages, url_filters.listed_hosts(pages))


def op7_token_files(spark: SparkSession, folder: str) -> DataFrame:
    return token_files.write_and_read(table(spark, folder, "documents"), vocabulary_path())


def op8_ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates.near_duplicates(table(spark, folder, "documents"))


def op9_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    return html_text.main_texts(table(spark, folder, "pages"))


def op10_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality.judge(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op11_document_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprints.edited_report(table(spark, folder, "documents"))


def op12_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    return conversations.report(table(spark, folder, "conversations"))


def op13_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    return periodic_runs.report(table(spark, folder, "documents"))


def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    return corpus_pipeline.run(spark, folder)


def llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (op1_best_fit_packing, op2_decontamination, op3_secret_scans, op4_license_scans, op5_language_id, op6_url_filters,
             op7_token_files, op8_ngram_jaccard_join, op9_html_extraction, op10_quality_rules,
             op11_document_fingerprints, op12_conversation_repair, op13_periodic_runs, pipeline)
    return {f.__name__: f for f in found}


def llm_oracle() -> dict[str, str]:
    return {"op6_url_filters": url_filters.oracle()}
