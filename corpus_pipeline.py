"""A training corpus from raw documents, one operator a stage.

Each stage reads all rows that the one before it kept and returns documents with the same
columns, the last one packed pieces.  What the stages decide takes effect: documents
scored under 0.5 go, of near-duplicates the one with the smallest id stays,
documents with a benchmark window go, personal data is replaced by its kind.
Nulls, empty texts, repeated rows, an empty table and further columns are handled as the
operators say; further columns are carried along up to the last stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidewatt.llm import decontamination, minhash, packing, private, quality
from tidewatt.llm.common import saved, table

# Scores, tokens and added spans are not what SQL can express; tests hold the stages against brute force.
ORACLE_SQL = None


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.good_documents(docs, table(spark, sf_dir, "labels"))


def near_deduplicated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash.deduplicated(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def private_masked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return private.masked(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.packed(docs)


STAGES = [
    ("quality_classifier", good_quality),
    ("minhash_near_dedup", near_deduplicated),
    ("benchmark_decontamination", decontaminated),
    ("private_data", private_masked),
    ("best_fit_packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the last stage; each stage's result is a table in the shared scratch folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
