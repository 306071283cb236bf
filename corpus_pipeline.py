"""The corpus pipeline: stages applied to ``documents``, each written as Parquet and read again."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import decontaminate, jaccard_join, line_dedup, mixing, quality_lm
from tidemark.llm import text as t
from tidemark.session import shared_folder


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents whose perplexity under the model of the trusted ones is too high for their language."""
    return quality_lm.remove_low_quality(docs, quality_lm.trusted_ids(t.read(spark, sf_dir, "labels")))


def duplicate_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts lines that stand earlier in the corpus, equal or within two edits; drops documents left without a line."""
    return line_dedup.line_dedup(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near copies: five-word shingles, similarity 0.8."""
    return jaccard_join.remove_near_duplicates(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a window of a benchmark item."""
    return decontaminate.remove_documents(docs, t.read(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixed text: each document's rows of the output shards, and how many of its words they take."""
    return mixing.mixed(docs)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("line_dedup", duplicate_lines),
    ("jaccard_join", near_duplicates),
    ("benchmark_decontamination", benchmark_decontamination),
    ("mix_sources", mix_sources),
]

# Fitted models, edit joins and similarity joins have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = t.read(spark, sf_dir, "documents")
    folder = f"{shared_folder(spark)}/corpus-{uuid.uuid4().hex}"
    for step, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{step}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
