"""The corpus pipeline: documents in, packed pieces of training sequences out.

Each stage takes (spark, docs, sf_dir), works on all rows its predecessor kept, and returns a
DataFrame; all but the last return the columns of `docs`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tabloom.llm.common import read_table, written
from tabloom.llm.decontaminate import drop_leaks
from tabloom.llm.exact_dedup import drop_copies
from tabloom.llm.minhash import drop_near_copies
from tabloom.llm.packing import pack_documents
from tabloom.llm.toxicity import drop_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below one half."""
    return drop_toxic(docs, read_table(spark, sf_dir, "labels"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each distinct text, the one with the largest id."""
    return drop_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group, the one with the smallest id."""
    return drop_near_copies(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return drop_leaks(docs, read_table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of sequences of at most 2048 ids."""
    return pack_documents(docs)


STAGES = [
    ("toxicity", toxicity),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("packing", packing),
]

# Scores of a trained model and ids of a tokenizer cannot be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
