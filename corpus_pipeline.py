"""From raw documents to packed training sequences, stage by stage.

Every stage works on all that its predecessor kept and is written as Parquet in
the shared folder before the next one reads it, so a lost executor costs at most
the stage at hand.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from samefold.llm import bagminhash, common, mixing, packing, secrets, toxicity


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return toxicity.drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays."""
    return bagminhash.drop_near_duplicates(docs)


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked in the texts."""
    return secrets.redact(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources are replicated to equal weights and shuffled globally."""
    return mixing.mix(docs).select(*docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their place in the training sequences."""
    return packing.best_fit_pack(docs)


STAGES = [
    ("toxicity", toxicity_stage),
    ("near_dedup", near_dedup_stage),
    ("secrets", secrets_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]

#: SQL can express neither the classifier nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = common.documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = common.staged(stage(spark, docs, sf_dir), name)
    return docs
