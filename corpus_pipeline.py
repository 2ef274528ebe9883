"""The corpus pipeline: stages over ``documents``, each written as Parquet and read again.

Every stage takes what the one before kept and returns it with the columns of
``documents``; the last one returns the packed sequences' pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from courtline.llm import decontamination, exact_dedup, packing, simhash, toxicity
from courtline.llm.common import written
from courtline.llm.queries import table, tokenizer_path


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.5 or more go; learned from the labelled documents of this stage's input."""
    return toxicity.reject_toxic(docs, table(spark, sf_dir, "labels"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text stays, the one with the largest id."""
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of fingerprints within 4 bits stays, the one with the smallest id."""
    return simhash.drop_near_copies(docs, width=4, radius=4)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a copy of a benchmark item, edited or not, go."""
    return decontamination.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every document, with its place in a sequence."""
    return packing.pack(packing.pieces(docs, tokenizer_path())).withColumnRenamed("id", "doc_id")


STAGES = [
    ("toxicity", reject_toxic),
    ("exact_dedup", drop_copies),
    ("simhash_near_dedup", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("packing", pack),
]

# Trained models, fingerprints and alignments are beyond SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
