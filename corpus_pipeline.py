"""From raw documents to packed training sequences."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.llm import decontamination, jaccard, packing, pii, quality
from feedloom.llm.common import table
from feedloom.session import Staging


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the quality discriminant, learned from all labels, does not reject."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def distinct_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of copies and near copies."""
    return jaccard.drop_near_duplicates(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that hold no benchmark passage."""
    return decontamination.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind; n_chars is that of the new text."""
    return pii.redact(docs).withColumn("n_chars", F.length("text").cast("long"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids in sequences of power-of-two lengths."""
    return packing.pack_power_of_two(docs)


STAGES = [
    ("quality", good_quality),
    ("near_duplicates", distinct_texts),
    ("decontamination", without_benchmark),
    ("pii", without_personal_data),
    ("packing", packed),
]

# No stage but the last is within SQL's reach; tests hold each against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows for the table ``documents``; every stage is written down and read again."""
    staging, docs = Staging(spark, "pipeline"), table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staging.write(stage(spark, docs, sf_dir), name)
    return docs
