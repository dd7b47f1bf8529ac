"""The corpus pipeline: documents through five of the training-data operators.

Every stage takes the table its predecessor wrote and returns what goes on: toxic documents go,
then those that the quality rules reject, then all but one of each group of near duplicates, then
those that hold benchmark windows; what is left is encoded into pieces and decoded again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tickflow.llm.decontaminate import drop_contaminated
from tickflow.llm.near_dup import keep_one
from tickflow.llm.quality import keep_good
from tickflow.llm.queries import sentence_pieces
from tickflow.llm.tables import read, settle
from tickflow.llm.toxicity import drop_toxic
from tickflow.llm.workers import small_batches


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return drop_toxic(docs, read(spark, sf_dir, "labels"))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return keep_good(docs, read(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return drop_contaminated(docs, read(spark, sf_dir, "benchmark"))


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return sentence_pieces(spark, docs)


STAGES = [
    ("toxicity", toxicity),
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("pieces", pieces),
]

# Two stages apply learned models, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written and read again; the last as it comes."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
