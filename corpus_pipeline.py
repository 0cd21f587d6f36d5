"""From raw documents to a training mix: five stages, each on all that the one before kept.

A stage takes (spark, docs, sf_dir) and returns documents with the columns of ``documents``; the last
one returns how much of each document the mix takes. Between stages, documents are written as Parquet
and read again, so a stage's decisions are fixed before the next one starts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import contamination, jaccard_join, mixing, quality, secrets
from tidemark.llm.frames import batch_bytes, free_name, stored, table
from tidemark.session import prepare


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, fitted on the labelled ones among them, accepts."""
    settings = quality.Settings()
    rows = quality.training_rows(docs.select("doc_id", "text"), table(spark, sf_dir, "labels"), F.lit(True), settings)
    name = free_name(docs, "quality_score")
    scored = quality.score(docs, quality.train(rows, settings), settings, score_col=name)
    return scored.where(F.col(name) >= settings.threshold).select(*docs.columns)


def keep_distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the least id, of each group of near duplicates."""
    return jaccard_join.keep_one(docs)


def keep_uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of whose words less than one in twenty stands in a window of a benchmark item."""
    return contamination.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mask(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with their secrets masked."""
    return secrets.mask_secrets(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How often the mix takes each document."""
    return mixing.mix(docs).select("doc_id", "size", "source_size", "target", "taken")


STAGES = [
    ("quality classifier", keep_good),
    ("n-gram Jaccard join", keep_distinct),
    ("benchmark decontamination", keep_uncontaminated),
    ("secret scans", mask),
    ("mixing to target weights", mix),
]

# Rows of whole texts that the JVM and a Python worker hand each other at a time.
BATCH_BYTES = "4m"

# No stage but the filter on its results can be said in SQL; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    with batch_bytes(spark, BATCH_BYTES):
        for name, stage in STAGES[:-1]:
            docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
