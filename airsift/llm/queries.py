"""Registered queries: each operator with its production parameters over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from airsift.llm import (
    chat_format, decontaminate, golay_simhash, importance, language_id, merkle_manifest, mixing, near_dedup, pii, quality_crf,
    quality_rules, suffix_dedup, url_filter,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def query(function):
    QUERIES[function.__name__] = function
    return function


@query
def op1_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.contaminated(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


@query
def op2_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    return chat_format.repair(_table(spark, folder, "conversations"))


@query
def op3_pii(spark: SparkSession, folder: str) -> DataFrame:
    return pii.personal_data(_table(spark, folder, "documents"))


@query
def op4_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffix_dedup.remove_repeats(_table(spark, folder, "documents"))


@query
def op5_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    trusted = quality_rules.trusted_documents(_table(spark, folder, "labels"))
    return quality_rules.quality(_table(spark, folder, "documents"), trusted)


@query
def op6_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_dedup.near_duplicates(_table(spark, folder, "documents"))


@query
def op7_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return language_id.identify(_table(spark, folder, "documents"))


@query
def op9_quality_crf(spark: SparkSession, folder: str) -> DataFrame:
    return quality_crf.classify(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


@query
def op10_mixing(spark: SparkSession, folder: str) -> DataFrame:
    labels = _table(spark, folder, "labels").select("doc_id", mixing.label_domain().alias("domain"))
    return mixing.mix(_table(spark, folder, "documents"), labels)


@query
def op8_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    pages = url_filter.label_pages(_table(spark, folder, "pages"), _table(spark, folder, "labels"))
    return url_filter.judge(pages)


SQL["op8_url_filter"] = url_filter.oracle()


@query
def op11_golay_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return golay_simhash.near_duplicates(_table(spark, folder, "documents"))


@query
def op12_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return merkle_manifest.manifest(_table(spark, folder, "documents"), merkle_manifest.without_line_breaks)


SQL["op12_merkle_manifest"] = merkle_manifest.oracle()


@query
def op13_importance_resampling(spark: SparkSession, folder: str) -> DataFrame:
    return importance.resample(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


SQL["op13_importance_resampling"] = importance.oracle()
