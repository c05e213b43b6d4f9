"""The corpus pipeline: documents through five stages, each written and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tickforge.llm import decontam, near_dedup, quality, secret_scan, sentencepiece_codec
from tickforge.llm.common import table, written
from tickforge.llm.queries import model_bytes


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the forest (fitted on the labelled ones) does not reject."""
    return quality.keep_good(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def minhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document (the smallest id) of each class of near duplicates."""
    return near_dedup.keep_first(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontam.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets in their texts replaced."""
    scanned = written(secret_scan.scan(docs), "secrets-scanned")
    return secret_scan.redact(docs, secret_scan.train(scanned))


def sentencepiece_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, decoded again as a check."""
    return sentencepiece_codec.encode_documents(docs, model_bytes())


STAGES = [
    ("quality_classifier", quality_classifier),
    ("minhash_near_dedup", minhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("secret_scans", secret_scans),
    ("sentencepiece_encoding", sentencepiece_encoding),
]

#: A learned forest, signatures and merges have no SQL form; the tests use brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
