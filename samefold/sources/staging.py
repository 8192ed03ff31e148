"""Tables written once and read by several consumers (IO12, IO13, IO15)."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder that the cluster shares; one of our own only beside a local master."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        found = spark.sparkContext._jsc.sc().getCheckpointDir()
        base = found.get() if found.isDefined() else None
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a shared folder")
        base = "file://" + tempfile.mkdtemp(prefix="samefold-")
        spark.sparkContext.setCheckpointDir(base)
    return base.rstrip("/")


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: consumers share one computation."""
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    schema = df.schema
    df.write.parquet(path)
    return df.sparkSession.read.schema(schema).parquet(path)


def exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def cached(spark: SparkSession, path: str, rows: int, build) -> DataFrame:
    """The table at ``path``, built anew if it is absent, unfinished or has other than ``rows`` rows (IO14)."""
    if exists(spark, f"{path}/_SUCCESS"):
        found = spark.read.parquet(path)
        if found.count() == rows:
            return found
    build().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def registered(df: DataFrame, name: str) -> DataFrame:
    """``df`` under a name for SQL."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def require_unique(df: DataFrame, *keys: str) -> DataFrame:
    """``df``, or an error if a key repeats."""
    n = df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1").count()
    if n:
        raise ValueError(f"{n} keys of {keys} repeat")
    return df
