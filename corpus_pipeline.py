"""A training corpus from raw documents: the good, once each, without benchmark leaks or secrets, packed into sequences.

Each stage takes all that its predecessor kept, written as Parquet and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from riskloom.llm import decontaminate, jaccard, packing, quality, secrets, tokens
from riskloom.llm.queries import table, tokenizer
from riskloom.session import staged


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the classifier rejects; it learns from the labels of its training folds."""
    return quality.good_documents(docs, table(spark, sf_dir, "labels"))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the smallest doc_id of each group of near-duplicates."""
    return jaccard.one_of_each(docs)


def without_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that contain a benchmark item, verbatim or with other values."""
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Put the kind of each secret in its place; every document stays."""
    return secrets.redact_documents(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their place in a sequence."""
    return packing.pack(tokens.token_counts(docs, tokenizer(), by_word=True))


STAGES = [
    ("quality_classifier", good_quality),
    ("jaccard_join", one_of_each_group),
    ("benchmark_decontamination", without_leaks),
    ("secret_scan", without_secrets),
    ("best_fit_packing", packed),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name.replace("_", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
