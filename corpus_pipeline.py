"""A training corpus from raw documents, in stages; each works on all that the stage before kept.

Every stage but the last returns the columns of ``documents``; the last one returns the mix: doc_id, size, source_size, target, taken.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tapelake.llm import contamination, fuzzy_lines, jaccard_join, mixing, toxicity
from tapelake.llm.common import bounded_batches, table
from tapelake.plans.staging import stage


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts; it is learned from the labels of these documents."""
    return toxicity.accepted(docs, toxicity.learn(docs, table(spark, sf_dir, "labels", "doc_id", "toxic")))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without lines that repeat lines of other documents or their own."""
    return fuzzy_lines.dedup_lines(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return jaccard_join.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no item of the benchmark."""
    return contamination.decontaminate(docs, table(spark, sf_dir, "benchmark", "item_id", "text"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How many words of each document the mix takes."""
    return mixing.mix(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("ngram_jaccard_join", drop_near_copies),
    ("benchmark_decontamination", drop_contaminated),
    ("mixing_sources", mix_sources),
]

# Learned scores, edit distances and seeded draws aren't SQL; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each result is written to the shared folder and read again."""
    bounded_batches(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
