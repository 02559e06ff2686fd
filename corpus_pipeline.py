"""From raw documents to packed training sequences.

Each stage takes all that its predecessor kept, is written as Parquet and read again. The cheap
filters come first, so the stages that shuffle see fewer rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from geomosaic.llm import exact_dedup, minhash, packing, quality_classifier, quality_rules
from geomosaic.llm.common import read, staged


def quality_rules_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a rule rejects go."""
    return quality_rules.keep_good(docs)


def quality_classifier_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score is below the threshold go; the model learns from the labels of what is left."""
    return quality_classifier.keep_accepted(docs, read(spark, sf_dir, "labels"))


def exact_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts one document stays."""
    return exact_dedup.keep_one(docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates one document stays."""
    return minhash.keep_one(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces with their ids and places in training sequences."""
    return packing.pack(docs)


STAGES = [
    ("quality rules", quality_rules_stage),
    ("quality classifier", quality_classifier_stage),
    ("exact dedup", exact_dedup_stage),
    ("MinHash near-dedup", near_dedup_stage),
    ("packing", packing_stage),
]

#: A fitted classifier and token ids are not SQL; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-").lower())
    return STAGES[-1][1](spark, docs, sf_dir)
