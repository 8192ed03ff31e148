"""Shared plumbing: scratch tables in the shared folder, id keys, Arrow limits."""

from __future__ import annotations

import ctypes
import gc
import os
import tempfile
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows in one Arrow batch handed to Python.  Texts may be very long, so the
#: batch is also bounded in bytes where Spark offers that setting.
ARROW_ROWS = 1024
ARROW_BYTES = 16 << 20


def configure(spark: SparkSession) -> None:
    """Bound the Arrow batches that Python workers receive."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))


def shared_dir(spark: SparkSession) -> str:
    """The folder that the cluster shares (``spark.checkpoint.dir``).

    A folder of our own is used only where the setting is absent beside a local
    master, as in tests, where driver and executors are one process.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        found = spark.sparkContext._jsc.sc().getCheckpointDir()
        base = found.get() if found.isDefined() else None
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="samefold-")
        spark.sparkContext.setCheckpointDir(base)
    return base.rstrip("/")


def shared_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back.

    Cuts the lineage: later stages re-read the table after a lost executor
    instead of recomputing what lies before it.
    """
    spark = df.sparkSession
    path = shared_path(spark, name)
    schema = df.schema
    df.write.parquet(path)
    out = spark.read.schema(schema).parquet(path)
    out._samefold_path = path
    return out


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of our own in the shared folder."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def dispose(df: DataFrame) -> None:
    """Delete the files behind a ``staged`` table that nothing reads any more."""
    path = getattr(df, "_samefold_path", None)
    if path:
        remove(df.sparkSession, path)


def free_shuffles(spark: SparkSession) -> None:
    """Have Spark delete the files of finished shuffles now; it does so when the driver collects their handles."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def parts(spark: SparkSession, rows: int, each: int) -> int:
    """Partitions for ``rows`` that are dealt by an explicit count, ``each`` a task; grows with the table."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-int(rows) // each))


#: Rows of few bytes that may be broadcast.
BROADCAST_ROWS = 1_000_000


def few(df: DataFrame, rows=BROADCAST_ROWS) -> bool:
    """Whether a narrow table is proven small enough to broadcast."""
    return df.limit(rows + 1).count() <= rows


def join_small(left: DataFrame, right: DataFrame, keys, how="inner", rows=BROADCAST_ROWS) -> DataFrame:
    """``left`` joined with a narrow table, which is broadcast only if it is proven small."""
    return left.join(F.broadcast(right) if few(right, rows) else right, keys, how)


def repeated_ids(docs: DataFrame, id_col="doc_id") -> DataFrame:
    """(doc_id) of ids that several rows have, staged."""
    ids = docs.select(F.col(id_col).cast("long").alias("doc_id")).where("doc_id IS NOT NULL")
    return staged(ids.groupBy("doc_id").agg(F.count("*").alias("k")).where("k > 1").select("doc_id"), "repeated")


def one_text(docs: DataFrame, id_col="doc_id", text_col="text") -> DataFrame:
    """(doc_id, text) with one row an id, null ids left out; an id with several texts
    stands for the least of them, a null text for an empty one."""
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).where("doc_id IS NOT NULL")
    many = repeated_ids(docs, id_col)
    if many.isEmpty():
        return src
    once = join_small(src, many, "doc_id", "left_semi").groupBy("doc_id").agg(F.min("text").alias("text"))
    return join_small(src, many, "doc_id", "left_anti").unionByName(once)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def held_out(col) -> "F.Column":
    """True for rows kept out of every fit: crc32(id as text) mod 5 is 0."""
    return F.crc32(F.coalesce(col.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def tokenizer_path(path: str | None) -> str:
    """Place of a tokenizer file; a bare name is looked up in the public set."""
    name = path or "word_bpe_49k.json"
    if os.sep in name:
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


def slices(sizes, most: int = 2_000_000):
    """Index ranges of an Arrow array of sizes that hold about ``most`` in all."""
    n = len(sizes)
    if n:
        ends = np.cumsum(pc.fill_null(sizes, 0).to_numpy(zero_copy_only=False).astype(np.int64))
        cuts = np.unique(np.searchsorted(ends, np.arange(most, ends[-1], most)) + 1)
        edges = np.unique(np.concatenate([[0], cuts[cuts < n], [n]])).tolist()
        yield from zip(edges, edges[1:])


def tidied(run):
    """``run`` for mapInArrow; a reused worker gives its memory back after each task."""

    def inner(batches):
        try:
            yield from run(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
            if trim:
                trim(0)

    return inner
