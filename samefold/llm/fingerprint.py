"""Canonical exact digests of documents.

Canonical form: NFKC, full case folding, runs of white space folded to one
space, ends trimmed.  The fingerprint is the 128-bit xxh3 digest of its UTF-8
bytes in hex.  Documents meet by fingerprint; inside a bucket of equal
fingerprints the canonical bytes themselves are compared, so a chance collision
never makes two different texts equal.

Defined results: a null text is an empty text; repeated rows are kept, each
with its own result; null ids sort before all others; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import functools
import hashlib
import json
import math
import unicodedata

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from samefold.llm import common

LOWEST = -(1 << 63)
#: Fewer than this many keys can hold more than 1 / HOT_KEYS of the rows each.
HOT_KEYS = 2000
#: Members of a bucket whose texts meet its first text in one group.
BUCKET_GROUP = 128


def canonical(text: str | None) -> str:
    return " ".join(unicodedata.normalize("NFKC", unicodedata.normalize("NFKC", text or "").casefold()).split())


def digest(canon: str) -> str:
    return xxhash.xxh3_128_hexdigest(canon.encode("utf-8", "surrogatepass"))


def likeness(a: str, b: str, fa: str, fb: str) -> float:
    """1 for equal fingerprints of byte-equal canonical texts, else 0."""
    return 1.0 if fa == fb and a == b else 0.0


def fingerprints(docs: DataFrame, id_col="doc_id", text_col="text", with_canonical=False, carry: str | None = None) -> DataFrame:
    """Rows (doc_id, fingerprint[, canonical][, the integer column ``carry``]) of every document."""
    common.configure(docs.sparkSession)

    def run(batches):
        for b in batches:
            canon = [canonical(t) for t in b.column(1).to_pylist()]
            cols = [b.column(0), pa.array([digest(c) for c in canon], pa.string())]
            names = ["doc_id", "fingerprint"]
            if with_canonical:
                cols.append(pa.array(canon, pa.large_string()).cast(pa.string()))
                names.append("canonical")
            if carry:
                cols.append(b.column(2))
                names.append(carry)
            yield pa.RecordBatch.from_arrays(cols, names)

    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), *([F.col(carry).cast("long").alias(carry)] if carry else []))
    return src.mapInArrow(common.tidied(run), "doc_id long, fingerprint string" + ", canonical string" * with_canonical + (f", {carry} long" if carry else ""))


def join_counted(rows: DataFrame, table: DataFrame, keys: list[str], n: str, total: int) -> DataFrame:
    """``rows`` joined with ``table``, which has a row a key and its number ``n`` of rows.

    Keys with more than 1 / ``HOT_KEYS`` of all ``total`` rows, of which there are
    fewer than ``HOT_KEYS``, are broadcast, so their rows stay where they are; the
    rows of any other key are too few to weigh on a task.
    """
    hot = F.col(n) * HOT_KEYS > total
    few = F.broadcast(table.where(hot))
    return rows.join(few, keys).unionByName(rows.join(F.broadcast(table.where(hot).select(keys)), keys, "left_anti").join(table.where(~hot), keys))


def with_wanted(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """``rows`` with texts joined with narrow ``wanted`` by ``_key``, so that no text is shuffled.

    ``wanted`` is broadcast in slices of about ``common.BROADCAST_ROWS`` keys; each slice
    reads ``rows`` once.
    """
    n = max(1, -(-wanted.count() // common.BROADCAST_ROWS))
    part = F.pmod(F.xxhash64("_key"), F.lit(n))
    out = [rows.where(part == i).join(F.broadcast(wanted.where(part == i)), "_key") for i in range(n)]
    return functools.reduce(DataFrame.unionByName, out)


def exact_groups(docs: DataFrame, id_col="doc_id", text_col="text") -> DataFrame:
    """Rows (doc_id, fingerprint, first_id, n_equal): the class of each document.

    Fingerprints alone are counted first, with map-side combining.  Only members
    of a bucket of two or more send their text on, to be compared byte by byte
    with the text of the bucket's first document, in groups of about
    ``BUCKET_GROUP`` members with a copy of that text each.  Texts that differ inside a
    bucket form classes of their own by SHA-256 of the canonical bytes.
    """
    fps = common.staged(fingerprints(docs, id_col, text_col), "fingerprints")
    total = fps.count()
    sizes = common.staged(fps.groupBy("fingerprint").agg(F.count("*").alias("n")).where("n > 1"), "sizes")
    groups = F.ceil(F.col("n") / BUCKET_GROUP)
    many = join_counted(fps, sizes, ["fingerprint"], "n", total)
    key = F.coalesce(F.col(id_col).cast("long"), F.lit(LOWEST))
    # an id met in several buckets takes the fewest groups, which all of them have
    wanted = many.groupBy(F.coalesce("doc_id", F.lit(LOWEST)).alias("_key")).agg(F.min(groups).alias("_groups"))
    wanted = common.staged(wanted, "wanted")
    involved = with_wanted(docs.select(key.alias("_key"), F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")), wanted)
    involved = involved.withColumn("group", F.pmod(F.xxhash64("doc_id"), F.col("_groups")))
    texts = common.staged(fingerprints(involved, with_canonical=True, carry="group"), "texts")  # read twice
    first = texts.groupBy("fingerprint").agg(F.min_by("canonical", F.coalesce("doc_id", F.lit(LOWEST))).alias("first_text"))
    first = first.join(sizes, "fingerprint").select("fingerprint", "first_text", F.explode(F.sequence(F.lit(0).cast("long"), groups - 1)).alias("group"))
    compared = texts.join(first, ["fingerprint", "group"]).select(
        "doc_id", "fingerprint", F.when(F.col("canonical") == F.col("first_text"), F.lit("")).otherwise(F.sha2("canonical", 256)).alias("split"))
    compared = common.staged(compared, "buckets")
    for old in (sizes, wanted, texts):
        common.dispose(old)
    classes = common.staged(compared.groupBy("fingerprint", "split").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("n_equal")), "classes")
    common.free_shuffles(docs.sparkSession)
    equal = join_counted(compared, classes, ["fingerprint", "split"], "n_equal", total).select("doc_id", "fingerprint", "first_id", "n_equal").dropDuplicates(["doc_id", "fingerprint", "first_id"])
    return fps.join(equal, (fps.doc_id.eqNullSafe(equal.doc_id)) & (fps.fingerprint == equal.fingerprint), "left").select(
        fps.doc_id, fps.fingerprint, F.coalesce("first_id", fps.doc_id).alias("first_id"), F.coalesce("n_equal", F.lit(1)).alias("n_equal"))


def with_next(docs: DataFrame, id_col="doc_id", text_col="text", rows_per_range=2000) -> DataFrame:
    """Rows (range, ghost, key, doc_id, text) grouped for a scan in id order.

    Ids alone are ranked into ranges; each range also gets the first document
    of the following one as a ghost (the last range that of the first), so one
    streaming pass over a range sees every document with its successor.  With
    ``n`` documents there are n / ``rows_per_range`` ranges, from a few million
    documents on the root of n: both their number and their size grow slowly.
    """
    key = F.coalesce(F.col(id_col).cast("long"), F.lit(LOWEST))
    ids = docs.select(key.alias("key"))
    n = ids.count()
    parts = max(1, -(-n // max(rows_per_range, math.isqrt(n))))
    cuts = ids.agg(F.percentile_approx("key", [i / parts for i in range(1, parts)] or [0.5], 20 * parts)).first()[0] if parts > 1 else []
    cuts = sorted(set(cuts or []))
    spark = docs.sparkSession
    # two steps of a root of the cuts each, the second inside the block that the first finds
    step = max(1, math.isqrt(len(cuts)))
    blocks = [cuts[i : i + step] for i in range(0, len(cuts), step)]
    kind = "array<array<long>>"
    table = F.from_json(F.lit(json.dumps(blocks)), kind)
    ends = F.from_json(F.lit(json.dumps([b[-1] for b in blocks])), "array<long>")

    def bucket(k):
        full = F.size(F.filter(ends, lambda c: c < k))
        return full * step + F.size(F.filter(F.coalesce(F.get(table, full), F.array().cast("array<long>")), lambda c: c < k))

    firsts = {r[0]: r[1] for r in ids.groupBy(bucket(F.col("key")).alias("b")).agg(F.min("key").alias("k")).collect()}  # a row a range
    order = sorted(firsts)
    before = [(firsts[b], order[i - 1], i == 0) for i, b in enumerate(order)]
    ghosts = spark.createDataFrame(before or [(0, 0, False)], "first_key long, to_range int, wraps boolean").where(F.lit(bool(before)))
    rows = docs.select(key.alias("key"), F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.join(F.broadcast(ghosts), rows.key == ghosts.first_key, "left")
    own = F.struct(bucket(F.col("key")).alias("range"), F.lit(False).alias("ghost"))
    ghost = F.struct(F.col("to_range").alias("range"), F.lit(True).alias("ghost"))
    rows = rows.withColumn("at", F.explode(F.when(F.col("to_range").isNull(), F.array(own)).otherwise(F.array(own, ghost))))
    rows = rows.select("at.range", "at.ghost", "key", "doc_id", "text")
    return rows.repartitionById(parts, "range").sortWithinPartitions("range", "ghost", "key", "text")


def edited_fingerprints(docs: DataFrame, id_col="doc_id", text_col="text") -> DataFrame:
    """Fingerprints of each document and of its text edited with its successor.

    The last floor(n/2) code points are replaced by the first as many (or all)
    of the next document in ascending id order; the first document follows the
    last.  Equal ids follow one another in text order.
    """
    common.configure(docs.sparkSession)
    out_schema = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"

    def scan(batches):
        last = None

        def finish(row, nxt):
            doc, text, canon, fp = row
            _, other, ocanon, ofp = nxt
            half = len(text) // 2
            edited = text[: len(text) - half] + other[:half]
            ecanon = canonical(edited)
            efp = digest(ecanon)
            return (doc, len(text), hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(), fp, efp, likeness(canon, ecanon, fp, efp), likeness(canon, ocanon, fp, ofp))

        for b in batches:
            out = []
            for rng, ghost, doc, text in zip(*(b.column(i).to_pylist() for i in (0, 1, 3, 4))):
                if last and last[0] != rng:
                    last = None
                if ghost and not last:
                    continue  # only the first ghost of a range counts
                c = canonical(text)
                row = (doc, text, c, digest(c))
                if last:
                    out.append(finish(last[1], row))
                last = None if ghost else (rng, row)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*out)) or [[]] * 7, (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()))], ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])

    return with_next(docs, id_col, text_col).mapInArrow(common.tidied(scan), out_schema)


def fingerprint_report(docs: DataFrame, id_col="doc_id", text_col="text") -> DataFrame:
    """``edited_fingerprints`` with each document's class of equal texts."""
    report = edited_fingerprints(docs, id_col, text_col)
    classes = exact_groups(docs, id_col, text_col).select(F.col("doc_id").alias("_id"), F.col("fingerprint").alias("_fp"), "first_id", "n_equal").dropDuplicates(["_id", "_fp", "first_id"])
    return report.join(classes, report.doc_id.eqNullSafe(F.col("_id")) & (report.fingerprint == F.col("_fp")), "left").drop("_id", "_fp")
