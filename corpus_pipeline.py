"""The corpus pipeline: filters, near-duplicates, repeated passages, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as
Parquet and read again as the next one's ``docs``; all but the last return the columns
of ``documents``.  Null doc_ids pass (they are judged by their text alone).

An empty table gives no rows at any stage; null texts count as empty.  Repeated rows are
judged alike by the filters; of those with words, the Jaccard join leaves one, those
without words all stay.  Other columns, whatever their names, are kept as they are up to
the packing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from docbridge.llm import jaccard_join, packing, quality, substring_dedup, toxicity
from docbridge.llm.common import checkpoint, table


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose probability of the upper grade reaches the threshold stay."""
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.select(docs, model)


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score under one half stay."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.select(docs, model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component stays: the one with the least doc_id."""
    return jaccard_join.representatives(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words of passages that occurred before go; every document stays."""
    return substring_dedup.clean(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents, each with its sequence and offset."""
    return packing.pack(docs)


STAGES = [
    ("quality classifier", quality_classifier),
    ("toxicity", toxicity_filter),
    ("n-gram Jaccard join", near_duplicates),
    ("substring dedup", repeated_passages),
    ("best-fit packing", best_fit_packing),
]

#: Learned models and packing can't be expressed in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        docs = checkpoint(out, docs) if i + 1 < len(STAGES) else out
    return docs
