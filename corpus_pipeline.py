"""Documents to a training mix, in stages that are each written as Parquet and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from airsift.llm import decontaminate, mixing, near_dedup, pii, quality_rules
from airsift.llm.store import stored

# Hundredths of shared five-word shingles from which documents of a corpus count as copies.
NEAR_SIMILARITY = 80


def good_documents(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    return quality_rules.keep_good(docs, spark.read.parquet(f"{folder}/labels.parquet"))


def one_of_each_group(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    return near_dedup.keep_one_each(docs, NEAR_SIMILARITY)


def without_benchmark(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    return decontaminate.keep_clean(docs, spark.read.parquet(f"{folder}/benchmark.parquet"))


def without_personal_data(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    return pii.mask(docs)


def mixed(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    labels = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", mixing.label_domain().alias("domain"))
    return mixing.with_copies(docs, labels)


STAGES = [
    ("quality_rules", good_documents),
    ("near_dedup", one_of_each_group),
    ("decontamination", without_benchmark),
    ("pii", without_personal_data),
    ("mixing", mixed),
]

# Sketches, learned models and masks have no SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, folder), f"stage-{name}")
    return docs
