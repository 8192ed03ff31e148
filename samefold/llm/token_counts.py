"""Token counts per document from flat token files without an index.

A flat file holds nothing but little-endian token ids; an end-of-document id
closes each document.  Files are read in blocks of fixed size.  A vectorised
search finds the separators of a block; a prefix scan over the block summaries
(separators before the block, place of the last one) stitches documents that
cross block boundaries and numbers them.

Defined results: consecutive separators are empty documents of zero tokens;
tokens after the last separator are one unterminated document
(``terminated`` false); an empty file has no document; the separator is not
counted as a token.  For tables, a null or empty text has zero tokens.
"""

from __future__ import annotations

import os
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from samefold.llm import common, tokens

BLOCK_BYTES = 8 << 20
#: First id after the 49,408 of the vocabulary: no text can hold it, and it fits 16 bits.
EOD_ID = 49408


def _fs(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1))


def write_flat(docs: DataFrame, folder: str, eod_id: int, id_col="doc_id", text_col="text", dtype="<u2", tokenizer: str | None = None) -> DataFrame:
    """Tokenize into flat files, one a task; rows (file, doc_index, doc_id, n_bytes).

    A file's name is unique to the attempt that wrote it, and only the rows of
    attempts that Spark commits name files, so a lost task leaves at most an
    unused file.  ``n_bytes`` is the size of the whole file on its last row.
    """
    common.configure(docs.sparkSession)

    def run(batches):
        tok = tokens.load(tokenizer)
        width = np.dtype(dtype).itemsize
        fs, root = _fs(folder)
        fs.create_dir(root, recursive=True)
        name = f"{uuid.uuid4().hex}.bin"
        done, size, out = 0, 0, None
        for b in batches:
            ids, texts = b.column(0), b.column(1)
            for lo, hi in common.slices(pc.binary_length(texts), tokens.SLICE):
                if out is None:
                    out = fs.open_output_stream(f"{root}/{name}")
                flat, bounds = tok.flat(texts.slice(lo, hi - lo))
                if (flat == eod_id).any():
                    raise ValueError("a text holds the separator id")
                out.write(np.insert(flat, bounds[1:], eod_id).astype(dtype).tobytes())
                n = hi - lo
                sizes = size + (bounds[1:] + np.arange(1, n + 1)) * width
                size = int(sizes[-1])
                yield pa.RecordBatch.from_arrays([pa.array([f"{folder}/{name}"] * n, pa.string()), pa.array(range(done, done + n), pa.int64()), ids.slice(lo, n), pa.array(sizes, pa.int64())], ["file", "doc_index", "doc_id", "n_bytes"])
                done += n
        if out is not None:
            out.close()

    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return src.mapInArrow(common.tidied(run), "file string, doc_index long, doc_id long, n_bytes long")


def count_tokens(files: DataFrame, eod_id: int, dtype="<u2", block_bytes=BLOCK_BYTES) -> DataFrame:
    """Rows (file, doc_index, n_tokens, terminated) for rows (file, n_bytes)."""
    spark = files.sparkSession
    width = np.dtype(dtype).itemsize
    block_bytes -= block_bytes % width
    blocks = files.where("n_bytes > 0").select("file", "n_bytes", F.explode(F.sequence(F.lit(0), F.floor((F.col("n_bytes") - 1) / block_bytes).cast("int"))).alias("block"))
    blocks = blocks.repartition("file", "block")

    def scan(batches):
        for b in batches:
            out = ([], [], [], [], [], [], [])
            for file, total, block in zip(*(c.to_pylist() for c in b.columns)):
                fs, path = _fs(file)
                start = block * block_bytes
                with fs.open_input_file(path) as f:
                    flat = np.frombuffer(f.read_at(min(block_bytes, total - start), start), dtype)
                cut = np.flatnonzero(flat == eod_id) + start // width
                last = start + len(flat) * width >= total
                for col, v in zip(out, (file, block, len(cut), int(cut[0]) if len(cut) else None, int(cut[-1]) if len(cut) else None, np.diff(cut) - 1, total // width if last else None)):
                    col.append(v)
            kinds = (pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds)], ["file", "block", "n", "first", "last", "gaps", "file_tokens"])

    found = common.staged(blocks.mapInArrow(common.tidied(scan), "file string, block int, n long, first long, last long, gaps array<long>, file_tokens long"), "blocks")
    before = W.partitionBy("file").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    scanned = found.select("file", "block", "n", "first", "last", "file_tokens",
                           F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"),
                           F.coalesce(F.last("last", ignorenulls=True).over(before), F.lit(-1)).alias("open"))
    stitched = scanned.where("n > 0").select("file", F.col("base").alias("doc_index"), (F.col("first") - F.col("open") - 1).alias("n_tokens"), F.lit(True).alias("terminated"))
    end = F.coalesce("last", "open")
    tail = scanned.where(F.col("file_tokens").isNotNull() & (F.col("file_tokens") - 1 > end)).select("file", (F.col("base") + F.col("n")).alias("doc_index"), (F.col("file_tokens") - end - 1).alias("n_tokens"), F.lit(False).alias("terminated"))
    inner = found.join(scanned.select("file", "block", "base"), ["file", "block"]).select("file", "base", F.posexplode("gaps").alias("k", "n_tokens")).select("file", (F.col("base") + F.col("k") + 1).alias("doc_index"), "n_tokens", F.lit(True).alias("terminated"))
    return stitched.unionByName(tail).unionByName(inner)


def document_token_counts(docs: DataFrame, id_col="doc_id", text_col="text", eod_id=EOD_ID, tokenizer: str | None = None) -> DataFrame:
    """Rows (doc_id, n_tokens): write flat files, count by scanning them."""
    spark = docs.sparkSession
    folder = common.shared_path(spark, "flat")
    if "://" not in folder:
        folder = f"file://{os.path.abspath(folder)}"
    rows = common.staged(write_flat(docs, folder, eod_id, id_col, text_col, tokenizer=tokenizer), "written")
    counts = count_tokens(rows.groupBy("file").agg(F.max("n_bytes").alias("n_bytes")), eod_id)
    common.remove(spark, folder)  # the scan of its blocks is staged
    return rows.join(counts, ["file", "doc_index"]).select("doc_id", "n_tokens")
