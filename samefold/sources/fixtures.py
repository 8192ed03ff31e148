"""Stand-in records derived from the synthetic tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from samefold.functions import text


def entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(entity_id, src, name, address, country) from documents."""
    d = spark.read.parquet(f"{sf_dir}/documents.parquet")
    n = text.normalize_text(F.col("text"))
    w = F.slice(text.words(n), 1, 14)
    src = (F.col("doc_id") % 3 + 1).cast("int")
    return d.select(src.alias("src"), F.concat(F.lit("S"), src, F.lit("-"), F.col("doc_id")).alias("entity_id"), w.alias("w"), F.col("lang").alias("country")).select(
        "entity_id", "src", F.array_join(F.slice("w", 1, 6), " ").alias("name"), F.array_join(F.slice("w", 7, 8), " ").alias("address"), "country")


def numbered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same contract from parts, with a number in every address."""
    p = spark.read.parquet(f"{sf_dir}/part.parquet")
    src = (F.col("p_partkey") % 3 + 1).cast("int")
    return p.select(F.concat(F.lit("S"), src, F.lit("-"), F.col("p_partkey")).alias("entity_id"), src.alias("src"), F.col("p_name").alias("name"),
                    text.normalize_text(F.concat_ws(" ", "p_size", "p_type", "p_brand")).alias("address"), F.lower("p_brand").alias("country"))


def sides(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(source 1, sources 2 and 3)."""
    return df.where("src = 1").drop("src"), df.where("src > 1").drop("src")


def truth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(sid, cid) of documents with equal normalised text."""
    d = spark.read.parquet(f"{sf_dir}/documents.parquet")
    src = (F.col("doc_id") % 3 + 1).cast("int")
    e = d.select(src.alias("src"), F.concat(F.lit("S"), src, F.lit("-"), F.col("doc_id")).alias("id"), F.md5(text.normalize_text(F.col("text"))).alias("h"))
    a = e.where("src = 1").select(F.col("id").alias("sid"), "h")
    return a.join(e.where("src > 1").select(F.col("id").alias("cid"), "h"), "h").select("sid", "cid")


#: The same fixtures in SQL, as leading common table expressions.
NORM = r"trim(regexp_replace(trim(regexp_replace(lower(coalesce({}, '')), '[^\p{{L}}\p{{N}}_\s]', ' ', 'g')), '\s+', ' ', 'g'))"
ENTITIES_SQL = f"""
n AS (SELECT doc_id, lang, list_filter(string_split({NORM.format('text')}, ' '), lambda x: x <> '') AS w, md5({NORM.format('text')}) AS h FROM documents),
entities AS (SELECT 'S' || (doc_id % 3 + 1) || '-' || doc_id AS entity_id, (doc_id % 3 + 1)::INT AS src, array_to_string(w[1:6], ' ') AS name, array_to_string(w[7:14], ' ') AS address, lang AS country, h FROM n),
s1 AS (SELECT * FROM entities WHERE src = 1), s23 AS (SELECT * FROM entities WHERE src > 1),
truth AS (SELECT a.entity_id AS sid, b.entity_id AS cid FROM s1 a JOIN s23 b USING (h))"""
NUMBERED_SQL = f"""
entities AS (SELECT 'S' || (p_partkey % 3 + 1) || '-' || p_partkey AS entity_id, (p_partkey % 3 + 1)::INT AS src, p_name AS name, {NORM.format("(p_size || ' ' || p_type || ' ' || p_brand)")} AS address, lower(p_brand) AS country FROM part),
s1 AS (SELECT * FROM entities WHERE src = 1), s23 AS (SELECT * FROM entities WHERE src > 1)"""
