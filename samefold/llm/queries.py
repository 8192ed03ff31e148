"""The thin ``opN_<name>`` queries and their SQL, for the driver contract."""

from __future__ import annotations

from samefold.llm import bagminhash, embed_dedup, fingerprint, mixing, packing, quality, secrets, substring, token_counts, toxicity
from samefold.llm.common import documents


def op1_quality(spark, sf_dir):
    return quality.score(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op2_substring_dedup(spark, sf_dir):
    return substring.held_passages(documents(spark, sf_dir))


def op3_toxicity(spark, sf_dir):
    return toxicity.classify(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op4_token_counts(spark, sf_dir):
    return token_counts.document_token_counts(documents(spark, sf_dir))


def op5_fingerprints(spark, sf_dir):
    return fingerprint.fingerprint_report(documents(spark, sf_dir))


def op6_best_fit_packing(spark, sf_dir):
    return packing.best_fit_pack(documents(spark, sf_dir))


def op7_secret_scan(spark, sf_dir):
    return secrets.secret_report(documents(spark, sf_dir))


def op8_minhash_dedup(spark, sf_dir):
    return bagminhash.near_duplicates(documents(spark, sf_dir))


def op9_source_mixing(spark, sf_dir):
    return mixing.mix(documents(spark, sf_dir))


def op10_embedding_dedup(spark, sf_dir):
    return embed_dedup.dedup(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def queries() -> dict:
    return {name: f for name, f in globals().items() if name.startswith("op") and callable(f)}


def oracle_sql() -> dict[str, str]:
    return {"op7_secret_scan": secrets.ORACLE_SQL, "op9_source_mixing": mixing.ORACLE_SQL}
