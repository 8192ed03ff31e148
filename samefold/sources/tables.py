"""Readers and writers: records, truth, candidates and results (IO1-IO25)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window as W

RECORD = T.StructType([T.StructField(n, T.StringType()) for n in ("entity_id", "business_name", "business_address", "country")])
TRUTH = T.StructType([T.StructField(n, T.StringType()) for n in ("source1_entity_id", "matched_entity_ids")])
#: Accepted spellings of the record columns (fixed values).
ALIASES = {
    "entity_id": ("entity_id", "source2_entity_id", "source3_entity_id", "id", "record_id"),
    "business_name": ("business_name", "name", "company_name", "entity_name"),
    "business_address": ("business_address", "address", "address_full", "full_address"),
    "country": ("country", "country_code", "nation"),
}


def read_delimited(spark: SparkSession, path: str, schema: T.StructType | None = None, sep="\t", columns=None) -> DataFrame:
    """All-string scan; nothing is read as missing, absent values are empty texts.

    Quotes are doubled inside quoted values; a value must not hold a line break,
    so that files can be split among tasks.
    """
    reader = spark.read.option("sep", sep).option("header", True).option("quote", '"').option("escape", '"').option("nullValue", "\u0000").option("emptyValue", "")
    df = (reader.schema(schema) if schema else reader).csv(path)
    df = df.select(*columns) if columns else df
    return df.fillna("")


def read_records(spark: SparkSession, path: str, sep="\t") -> DataFrame:
    """Records under any accepted column spelling, renamed to the contract."""
    return resolve(read_delimited(spark, path, None, sep))


def column_named(df: DataFrame, names) -> str:
    lower = {c.lower(): c for c in df.columns}
    for n in names:
        if n.lower() in lower:
            return lower[n.lower()]
    raise KeyError(f"none of {list(names)} in {df.columns}")


def resolve(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(column_named(df, names)).alias(to) for to, names in ALIASES.items()])


def first_rows(df: DataFrame, n: int, key: str, offset=0) -> DataFrame:
    """Rows ``offset`` to ``offset + n`` in key order, whatever the file layout."""
    out = df.orderBy(key)
    return out.offset(offset).limit(n) if offset else out.limit(n)


def split_ids(c) -> "F.Column":
    """Ids of a delimited list, blanks dropped."""
    return F.filter(F.transform(F.split(c, r"[,;|\s]+"), lambda x: F.trim(x)), lambda x: x != "")


def truth_pairs(truth: DataFrame, prefix: str | None = None) -> DataFrame:
    """(sid, cid) of a ground-truth table, optionally of one source."""
    out = truth.select(F.col("source1_entity_id").alias("sid"), F.explode(split_ids(F.col("matched_entity_ids"))).alias("cid"))
    return (out.where(F.col("cid").startswith(prefix)) if prefix else out).distinct()


def read_candidates(spark: SparkSession, path: str, sep="\t") -> DataFrame:
    """(sid, cid, block_rank) from list or pair layout, told apart by header."""
    df = read_delimited(spark, path, None, sep)
    if "candidate_entity_ids" in df.columns:
        return df.select(F.col("source1_entity_id").alias("sid"), F.posexplode(split_ids(F.col("candidate_entity_ids"))).alias("p", "cid")).select("sid", "cid", (F.col("p") + 1).alias("block_rank"))
    return df.select(F.col("source1_entity_id").alias("sid"), F.col("source_entity_id").alias("cid"), F.col("block_rank").cast("int").alias("block_rank"))


def as_list(pairs: DataFrame, out: str, rank="block_rank", sep=",") -> DataFrame:
    """One row per sid with its cids in rank order, joined by ``sep``."""
    return pairs.groupBy("sid").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(F.col(rank).alias("r"), "cid"))), lambda x: x["cid"]), sep).alias(out))


def parsed_list(lists: DataFrame, column: str) -> DataFrame:
    """(sid, cid, block_rank) of one row per sid with its ids in order."""
    return lists.select("sid", F.posexplode(split_ids(F.col(column))).alias("p", "cid")).select("sid", "cid", (F.col("p") + 1).alias("block_rank"))


def fetched(source: DataFrame, ids: DataFrame, key="entity_id") -> DataFrame:
    """The rows of ``source`` whose key is asked for."""
    return source.join(ids.select(key).distinct(), key, "left_semi")


def write_delimited(df: DataFrame, path: str, sep="\t", mode="error", single=False, order=()) -> None:
    """Partitioned export, sorted by ``order``; ``single`` makes one file, for small reports only."""
    df = df.orderBy(*order) if order else df
    writer = (df.coalesce(1) if single else df).write.mode(mode).option("sep", sep).option("header", True).option("emptyValue", "").option("quote", '"').option("escape", '"')
    writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)


def unfinished(df: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Rows whose key an earlier run has not written (resume)."""
    return df.join(done.select(key).distinct(), key, "left_anti")


def require_rows(df: DataFrame, expected: int) -> DataFrame:
    """The table, or an error if a cached copy has another number of rows."""
    n = df.count()
    if n != expected:
        raise ValueError(f"{n} rows where {expected} were expected")
    return df


def require_paths(spark: SparkSession, *paths: str) -> None:
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for p in paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        if not path.getFileSystem(conf).exists(path):
            raise FileNotFoundError(p)


def keep_first(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key, the first in ``order``."""
    w = W.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")
