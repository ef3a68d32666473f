"""From raw documents to tokens: quality, near-duplicates, secrets, mixture, BPE."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tillsight.llm import bpe, mixing, quality, secrets, simhash
from tillsight.sources.shared import materialize


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, fitted on the labelled ones, does not reject."""
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group that SimHash links."""
    return simhash.keep_one(docs)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with the secrets in their texts replaced by their kind."""
    return secrets.redact_documents(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the weights of their sources ask."""
    return mixing.mix(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document of the mixture, with their digests."""
    return bpe.encode_documents(docs)


STAGES = [
    ("quality_classifier", good_documents),
    ("simhash_near_dedup", without_near_copies),
    ("secret_scans", without_secrets),
    ("mixing", mixed),
    ("bpe", encoded),
]

#: A network's scores, 64-bit hashes and BPE are beyond SQL: tests hold the rows against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are written to the shared folder for the next one."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
