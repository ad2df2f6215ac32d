"""A corpus pipeline of five stages, each of which works on what the one before it kept.

quality classifier -> language ID -> near-duplicate removal -> benchmark decontamination ->
mixing sources to target weights. All stages but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sparkgauge import configure
from sparkgauge.llm import decontaminate, language, mix, near_dedup, quality_model
from sparkgauge.llm.common import store, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the factorisation machine accepts; it learns from the labels of docs that are not held out."""
    configure(spark)
    return quality_model.accepted(docs, table(spark, sf_dir, "labels"))


def languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the corpus's languages; texts without a letter or unlike the predicted language go."""
    configure(spark)
    return language.in_languages(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (5-word shingles, similarity 0.8)."""
    configure(spark)
    return near_dedup.without_copies(docs, shingle_words=5, threshold=0.8)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a 10-word window of any benchmark item."""
    configure(spark)
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their place in the mixture of sources."""
    configure(spark)
    return mix.mix(docs)


STAGES = [
    ("quality classifier", quality),
    ("language ID", languages),
    ("near-dedup", near_duplicates),
    ("decontamination", decontaminated),
    ("mixing", mixed),
]

# The learned stages have no SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = store(docs, "stage")
    return docs
