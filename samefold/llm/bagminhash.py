"""Near-duplicate documents by BagMinHash of their word-shingle multisets.

The weight of a shingle is its count.  Every shingle owns a Poisson process on
the weight axis, split into the dyadic intervals (0,1], (1,2], (2,4], ...; a
process of an interval has its length as rate, each point carries a uniform
level in the interval and counts only up to the shingle's weight.  A point falls
into one of ``REGISTERS`` registers, which keep their earliest point; an interval
is left as soon as its next point lies behind the latest register.  Two registers
agree with probability the weighted Jaccard similarity.

Documents with equal words are one class and represented by their smallest id.
Representatives meet in bands of the signature.  In each bucket every member is
compared with one centre, the member whose buckets are fullest: for a text and
its edited copies that is the text.  Candidates are verified on the exact
multisets and joined into components.  Then the members of a bucket that still lie
in different components are compared with each other by fine sketches, a grid of
``QUERIES`` by ``SLICE`` members at a time.  A member with few candidates in a grid
cell sends them on as pairs; one with more, as in a family of pages that are just
not similar enough, is verified where the bucket streams past, and only a forest
of links leaves the task.  So no bucket sends on its pairs, and nothing is capped.

Defined results: texts without words (null, empty, blank) link with nothing;
a text of fewer than five words is one shingle; rows with equal ids are one
document, with the least of their texts, and give one row; rows with a null id are
kept by ``drop_near_duplicates`` and link with nothing; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from samefold.llm import common, shingles
from samefold.llm.common import slices
from samefold.llm.components import connected_components

BANDS, ROWS = 25, 5
REGISTERS = BANDS * ROWS
SIMILARITY = 0.8
#: Deviations below the expected agreement at which a candidate is let go.
SLACK = 3.0
#: Registers and slack of the sketch for members that one centre did not settle.
FINE, FINE_SLACK = 1024, 4.0
#: Members of a bucket that are compared with each other in one go.
QUERIES, SLICE = 512, 512
#: Candidates in a grid cell that one member may send on as pairs.
FEW = 8
#: Rows that one task of the comparison gets.
TASK_ROWS = 50_000


def least_agreement(similarity=SIMILARITY, registers=REGISTERS, slack=SLACK) -> int:
    return int(np.floor(registers * similarity - slack * np.sqrt(registers * similarity * (1 - similarity))))


def _uniform(x: np.ndarray) -> np.ndarray:
    return ((x >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53


def signatures(hashes: np.ndarray, owner: np.ndarray, weight: np.ndarray, n: int, registers=REGISTERS) -> np.ndarray:
    """Registers of ``n`` multisets given as (hash, owner, weight) elements."""
    top = int(weight.max(initial=1))
    seeds, docs, caps, lows, widths = [], [], [], [], []
    low, width, j = 0, 1, 0
    while low < top:  # intervals (0,1], (1,2], (2,4], ...
        on = weight > low
        seeds.append(shingles.mix(hashes[on] ^ np.uint64(j * 0x9E3779B97F4A7C15 & (1 << 64) - 1)))
        docs.append(owner[on])
        caps.append(weight[on])
        lows.append(np.full(on.sum(), low))
        widths.append(np.full(on.sum(), width))
        low, width, j = low + width, max(1, low + width), j + 1
    seed, doc, cap, lo, wide = map(np.concatenate, (seeds, docs, caps, lows, widths))
    best = np.full(n * registers, np.inf)
    mark = np.zeros(n * registers, np.uint64)
    x = np.zeros(len(seed))
    r = 0
    with np.errstate(over="ignore"):
        while len(seed):
            draw = shingles.mix(seed + np.uint64(3 * r + 1))
            x = x - np.log(_uniform(draw)) / wide
            level = lo + np.ceil(_uniform(shingles.mix(seed + np.uint64(3 * r + 2))) * wide)
            into = doc * registers + (shingles.mix(seed + np.uint64(3 * r + 3)) >> np.uint64(33)).astype(np.int64) % registers
            ok = level <= cap
            np.minimum.at(best, into[ok], x[ok])
            won = ok & (best[into] == x)
            mark[into[won]] = draw[won]
            last = best.reshape(n, registers).max(axis=1)
            on = x < last[doc]
            seed, doc, cap, lo, wide, x = seed[on], doc[on], cap[on], lo[on], wide[on], x[on]
            r += 1
    return (mark.reshape(n, registers) >> np.uint64(32)).astype(np.uint32)


def multisets(texts: pa.Array):
    """(shingle hashes, owners, counts, word bounds, word hashes), sorted by owner and hash."""
    words, wb = shingles.word_hashes(texts)
    h, sb = shingles.shingle_hashes(words, wb)
    owner = np.repeat(np.arange(len(texts)), np.diff(sb))
    order = np.lexsort((h, owner))
    h, owner = h[order], owner[order]
    first = np.ones(len(h), bool)
    first[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
    at = np.flatnonzero(first)
    return h[at], owner[at], np.diff(np.append(at, len(h))), wb, words


def sketch(src: DataFrame) -> DataFrame:
    """(doc_id, digest, sig) of every text (doc_id, text) with words."""
    common.configure(src.sparkSession)

    def run(batches):
        for b in batches:
            for lo, hi in slices(pc.binary_length(b.column(1))):
                h, owner, w, wb, words = multisets(b.column(1).slice(lo, hi - lo))
                some = np.diff(wb) > 0
                if not some.any():
                    continue
                place = np.cumsum(some) - 1
                sig = signatures(h, place[owner], w, int(some.sum()))
                dig = [xxhash.xxh3_128_digest(words[a:z].tobytes()) for a, z in zip(wb[:-1][some], wb[1:][some])]
                yield pa.RecordBatch.from_arrays([b.column(0).slice(lo, hi - lo).filter(pa.array(some)), pa.array(dig, pa.binary()), pa.array([s.tobytes() for s in sig], pa.binary())], ["doc_id", "digest", "sig"])

    return src.mapInArrow(common.tidied(run), "doc_id long, digest binary, sig binary")


def band_rows(sigs: DataFrame) -> DataFrame:
    """(band, key, doc_id) of every signature."""

    def run(batches):
        for b in batches:
            sig = np.stack([np.frombuffer(s, np.uint32) for s in b.column(1).to_pylist()]) if b.num_rows else np.zeros((0, REGISTERS), np.uint32)
            parts = sig.reshape(len(sig) * BANDS, ROWS).astype(np.uint64)
            key = np.zeros(len(parts), np.uint64)
            with np.errstate(over="ignore"):
                for j in range(ROWS):
                    key = shingles.mix(key ^ (parts[:, j] + np.uint64(j << 40)))
            ids = b.column(0).take(pa.array(np.repeat(np.arange(len(sig)), BANDS)))
            yield pa.RecordBatch.from_arrays([pa.array(np.tile(np.arange(BANDS, dtype=np.int32), len(sig))), pa.array(key.view(np.int64)), ids], ["band", "key", "doc_id"])

    return sigs.select("doc_id", "sig").mapInArrow(common.tidied(run), "band int, key long, doc_id long")


def _agreement(pairs: DataFrame, sigs: DataFrame) -> DataFrame:
    """Pairs (a, b) whose signatures agree enough, with their agreement."""
    s = sigs.select("doc_id", "sig")
    both = pairs.join(s.toDF("a", "sa"), "a").join(s.toDF("b", "sb"), "b")

    def run(batches):
        for t in batches:
            x = np.frombuffer(b"".join(t.column(2).to_pylist()), np.uint32).reshape(-1, REGISTERS)
            y = np.frombuffer(b"".join(t.column(3).to_pylist()), np.uint32).reshape(-1, REGISTERS)
            n = (x == y).sum(axis=1)
            ok = pa.array(n >= least_agreement())
            yield pa.RecordBatch.from_arrays([t.column(0).filter(ok), t.column(1).filter(ok), pa.array(n.astype(np.int32)).filter(ok)], ["a", "b", "agree"])

    return both.select("a", "b", "sa", "sb").mapInArrow(common.tidied(run), "a long, b long, agree int")


def _verified(pairs: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """Pairs whose multisets are similar enough."""

    def run(batches):
        for t in batches:
            size = pc.add(pc.binary_length(t.column(2)), pc.binary_length(t.column(3)))
            for lo, hi in slices(size):
                part = t.slice(lo, hi - lo)
                n = part.num_rows
                h, owner, w, _, _ = multisets(pa.concat_arrays([part.column(2).cast(pa.string()), part.column(3).cast(pa.string())]))
                ends = np.searchsorted(owner, np.arange(2 * n + 1))
                ok = []
                for i in range(n):
                    a, b = slice(ends[i], ends[i + 1]), slice(ends[n + i], ends[n + i + 1])
                    _, p, q = np.intersect1d(h[a], h[b], assume_unique=True, return_indices=True)
                    common_w = int(np.minimum(w[a][p], w[b][q]).sum())
                    total = int(w[a].sum() + w[b].sum()) - common_w
                    ok.append(common_w >= similarity * total)
                keep = pa.array(ok, pa.bool_())
                yield pa.RecordBatch.from_arrays([part.column(0).filter(keep), part.column(1).filter(keep)], ["u", "v"])

    both = pairs.select("a", "b").join(texts.toDF("a", "ta"), "a").join(texts.toDF("b", "tb"), "b")
    return both.select("a", "b", "ta", "tb").mapInArrow(common.tidied(run), "u long, v long")


def near_duplicates(docs: DataFrame, similarity=SIMILARITY, id_col="doc_id", text_col="text") -> DataFrame:
    """(doc_id, group_id, kept) of every id."""
    src = common.one_text(docs, id_col, text_col)
    sk = common.staged(sketch(src), "sketch")
    many = common.staged(sk.groupBy("digest").agg(F.min("doc_id").alias("rep"), F.count("*").alias("n")).where("n > 1").drop("n"), "classes")
    copies = common.staged(common.join_small(sk.select("doc_id", "digest"), many, "digest").where("doc_id <> rep").select("doc_id", "rep"), "copies")
    common.dispose(many)
    reps = common.join_small(sk.select("doc_id", "sig"), copies.select("doc_id"), "doc_id", "left_anti")
    bands = common.staged(band_rows(reps), "bands")
    sizes = common.staged(bands.groupBy("band", "key").agg(F.count("*").alias("n")).where("n > 1"), "sizes")
    met = common.staged(common.join_small(bands, sizes, ["band", "key"]), "shared")
    common.dispose(bands)
    common.dispose(sizes)
    popular = common.staged(met.groupBy("doc_id").agg(F.sum("n").alias("popularity")), "popular")
    shared = common.join_small(met.drop("n"), popular, "doc_id")
    centres = common.staged(shared.groupBy("band", "key").agg(F.max(F.struct("popularity", "doc_id"))["doc_id"].alias("centre")), "centres")
    crowded = common.staged(common.join_small(shared, centres, ["band", "key"]).drop("popularity"), "crowded")
    common.dispose(met)
    common.dispose(centres)
    stars = crowded.where("doc_id <> centre").select(F.least("doc_id", "centre").alias("a"), F.greatest("doc_id", "centre").alias("b")).distinct()
    sig = common.staged(common.join_small(reps, popular.select("doc_id"), "doc_id", "left_semi"), "signatures")
    tried = common.staged(_agreement(stars, sig).select("a", "b"), "tried")
    texts = common.staged(common.join_small(src, popular.select("doc_id"), "doc_id", "left_semi"), "texts")
    links = common.staged(_verified(tried, texts, similarity), "links")
    common.dispose(sk)
    comps = connected_components(links)
    more = _cross_links(crowded, comps, texts, tried, similarity)
    if more is not None:
        first, comps = comps, connected_components(links.unionByName(more))
        common.dispose(first)
    for old in (crowded, popular, sig, texts, tried, links):
        common.dispose(old)
    out = common.join_small(src.select("doc_id"), copies, "doc_id", "left").withColumn("rep", F.coalesce("rep", "doc_id"))
    out = common.join_small(out, comps.toDF("rep", "component"), "rep", "left").select("doc_id", F.coalesce("component", "rep").alias("group_id"))
    return out.withColumn("kept", F.col("doc_id") == F.col("group_id"))


def _fine_sketch(texts: DataFrame) -> DataFrame:
    """(doc_id, sig, fine, set): the band registers, a byte each of ``FINE`` others, the multiset."""

    def run(batches):
        for b in batches:
            for lo, hi in slices(pc.binary_length(b.column(1))):
                h, owner, w, _, _ = multisets(b.column(1).slice(lo, hi - lo))
                sig = signatures(h, owner, w, hi - lo)
                fine = signatures(h, owner, w, hi - lo, FINE).astype(np.uint8)
                at = np.searchsorted(owner, np.arange(hi - lo + 1))
                sets = [h[x:y].tobytes() + w[x:y].astype(np.int32).tobytes() for x, y in zip(at, at[1:])]
                yield pa.RecordBatch.from_arrays([b.column(0).slice(lo, hi - lo), *(pa.array([r.tobytes() for r in x], pa.binary()) for x in (sig, fine)), pa.array(sets, pa.binary())], ["doc_id", "sig", "fine", "bag"])

    return texts.select("doc_id", "text").mapInArrow(common.tidied(run), "doc_id long, sig binary, fine binary, bag binary")


def _bag(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = len(raw) // 12
    return np.frombuffer(raw, np.uint64, n), np.frombuffer(raw, np.int32, n, 8 * n)


def _similar(a, b, similarity: float) -> bool:
    _, p, q = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    both = int(np.minimum(a[1][p], b[1][q]).sum())
    return both >= similarity * (int(a[1].sum()) + int(b[1].sum()) - both)


def _grid(rows: DataFrame) -> DataFrame:
    """``rows`` (band, key, doc_id, ..., asks, chunks, slices) once for every grid cell they belong to."""
    own = F.pmod(F.xxhash64("doc_id"), F.col("chunks")).cast("int")
    mine = F.pmod(F.xxhash64("doc_id", F.lit(1)), F.col("slices")).cast("int")

    def cell(chunk, part, query):
        return F.struct(chunk.alias("chunk"), part.alias("slice"), F.lit(query).alias("query"))

    asks = F.when(F.col("asks"), F.transform(F.sequence(F.lit(0), F.col("slices") - 1), lambda i: cell(own, i, True))).otherwise(F.array().cast("array<struct<chunk:int,slice:int,query:boolean>>"))
    past = F.transform(F.sequence(F.lit(0), F.col("chunks") - 1), lambda i: cell(i, mine, False))
    return rows.withColumn("at", F.explode(F.concat(asks, past))).select("*", "at.*").drop("at", "chunks", "slices", "asks")


def _cells(batches, width: int):
    """((band, key), queries, members) of each grid cell; rows arrive in order, queries first."""
    now, rows = None, ([], [])
    for b in batches:
        key = list(zip(*(b.column(i).to_pylist() for i in range(4))))
        query = b.column(4).to_pylist()
        values = list(zip(*(b.column(i).to_pylist() for i in range(5, 5 + width))))
        for k, q, v in zip(key, query, values):
            if k != now:
                if rows[0] and rows[1]:
                    yield now[:2], *rows
                now, rows = k, ([], [])
            rows[not q].append(v)
    if rows[0] and rows[1]:
        yield now[:2], *rows


def _near(band: int, queries, members, least: int):
    """For every query: the members of other components whose fine sketches agree enough,
    that stand behind it or at home, and that it meets in no earlier band."""
    def arrays(rows):
        doc, comp, home, sig, fine = (list(c) for c in zip(*(r[:5] for r in rows)))
        return np.asarray(doc), np.asarray(comp), np.asarray(home), np.frombuffer(b"".join(sig), np.uint32).reshape(-1, BANDS, ROWS), np.frombuffer(b"".join(fine), np.uint8).reshape(-1, FINE)

    doc, comp, home, sig, fine = arrays(members)
    for i, (x, cx, _, sx, fx) in enumerate(zip(*arrays(queries))):
        ok = np.flatnonzero((comp != cx) & ((comp == home) | (x < doc)))
        ok = ok[(fine[ok] == fx).sum(axis=1) >= least]
        first = (sig[ok] == sx).all(axis=2).argmax(axis=1) == band
        yield i, int(x), doc, ok[first]


def _cross_links(crowded: DataFrame, comps: DataFrame, texts: DataFrame, tried: DataFrame, similarity: float) -> DataFrame | None:
    """Links between members of one bucket that lie in different components, as a forest.

    Only members outside the bucket's largest component look for partners, so a
    bucket that one component fills costs nothing.
    """
    spark = crowded.sparkSession
    rows = common.join_small(crowded.select("band", "key", "doc_id"), comps.toDF("doc_id", "component"), "doc_id", "left").withColumn("component", F.coalesce("component", "doc_id"))
    sizes = rows.groupBy("band", "key", "component").agg(F.count("*").alias("n"))
    best = F.max(F.struct("n", "component"))
    mixed = sizes.groupBy("band", "key").agg(best["component"].alias("home"), F.count("*").alias("kinds"), (F.sum("n") - best["n"]).alias("apart"), F.sum("n").alias("n")).where("kinds > 1")
    mixed = common.staged(mixed.select("band", "key", "home", "apart", "n", F.ceil(F.col("apart") / QUERIES).cast("int").alias("chunks"), F.ceil(F.col("n") / SLICE).cast("int").alias("slices")), "mixed")
    total = mixed.agg(F.sum(F.col("n") * F.col("chunks") + F.col("apart") * F.col("slices"))).first()[0]
    if not total:
        return None
    rows = common.staged(common.join_small(rows, mixed.drop("apart", "n"), ["band", "key"]).withColumn("asks", F.col("component") != F.col("home")), "members")
    fine = common.staged(_fine_sketch(common.join_small(texts, rows.select("doc_id").distinct(), "doc_id", "left_semi")), "fine")
    least = least_agreement(registers=FINE, slack=FINE_SLACK)
    order = ["band", "key", "chunk", "slice"]

    def dealt(rows, *more, parts):
        got = _grid(rows).join(fine.select("doc_id", "sig", "fine", *more), "doc_id").select(*order, "query", "doc_id", "component", "home", "sig", "fine", *more)
        return got.repartition(parts, *order).sortWithinPartitions(*order, F.desc("query"))

    def candidates(batches):
        """(band, key, x, y) of few candidates, (band, key, x, null) of a query that has many."""
        for (band, key), queries, members in _cells(batches, 5):
            out = []
            for _, x, doc, near in _near(band, queries, members, least):
                out += [(band, key, x, int(doc[j])) for j in near] if len(near) <= FEW else [(band, key, x, None)]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), (pa.int32(), pa.int64(), pa.int64(), pa.int64()))], ["band", "key", "x", "y"])

    found = common.staged(dealt(rows, parts=common.parts(spark, total, TASK_ROWS)).mapInArrow(common.tidied(candidates), "band int, key long, x long, y long"), "cross")
    pairs = found.where("y IS NOT NULL").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
    pairs = common.staged(pairs.join(tried, ["a", "b"], "left_anti"), "pairs")
    links = common.staged(_verified(pairs, texts, similarity), "links")
    dense = common.staged(found.where("y IS NULL").select("band", "key", F.col("x").alias("doc_id")).distinct(), "dense")
    common.dispose(found)
    common.dispose(pairs)
    if dense.isEmpty():
        for old in (mixed, rows, fine, dense):
            common.dispose(old)
        return links
    many = dense.groupBy("band", "key").agg(F.ceil(F.count("*") / QUERIES).cast("int").alias("chunks"))
    again = common.join_small(rows.drop("asks", "chunks"), many, ["band", "key"])
    again = common.staged(common.join_small(again, dense.withColumn("asks", F.lit(True)), ["band", "key", "doc_id"], "left").fillna(False, ["asks"]), "members")
    total = again.agg(F.sum(F.col("chunks") + F.when(F.col("asks"), F.col("slices")).otherwise(0))).first()[0]

    def verified(batches):
        for (band, _), queries, members in _cells(batches, 6):
            root: dict[int, int] = {}

            def find(i, root=root):
                while root.setdefault(i, i) != i:
                    root[i] = root[root[i]]
                    i = root[i]
                return i

            us, vs = [], []
            bags = [None] * len(members)
            for i, x, doc, near in _near(band, queries, members, least):
                mine = _bag(queries[i][5])
                for j in near.tolist():
                    y = int(doc[j])
                    if find(x) == find(y):
                        continue
                    if bags[j] is None:
                        bags[j] = _bag(members[j][5])
                    if _similar(mine, bags[j], similarity):
                        root[find(x)] = find(y)
                        us.append(x)
                        vs.append(y)
            if us:
                yield pa.RecordBatch.from_arrays([pa.array(us, pa.int64()), pa.array(vs, pa.int64())], ["u", "v"])

    more = dealt(again, "bag", parts=common.parts(spark, total, TASK_ROWS // 4)).mapInArrow(common.tidied(verified), "u long, v long")
    more = common.staged(more, "links")
    for old in (mixed, rows, fine, dense, again):
        common.dispose(old)
    return links.unionByName(more)


def drop_near_duplicates(docs: DataFrame, similarity=SIMILARITY, id_col="doc_id", text_col="text") -> DataFrame:
    """``docs`` with one document of each group, the one of smallest id, in one row an id."""
    gone = common.staged(near_duplicates(docs, similarity, id_col, text_col).where("NOT kept").select(F.col("doc_id").alias("_gone")), "gone")
    small = common.few(gone)
    left = docs.join(F.broadcast(gone) if small else gone, F.col(id_col).cast("long") == F.col("_gone"), "left_anti")
    many = common.repeated_ids(docs, id_col).withColumnRenamed("doc_id", "_many")
    if many.isEmpty():
        return left
    marked = left.join(F.broadcast(many) if common.few(many) else many, F.col(id_col).cast("long") == F.col("_many"), "left")
    rank = F.row_number().over(W.partitionBy("_many").orderBy(F.coalesce(F.col(text_col), F.lit(""))))
    once = marked.where("_many IS NOT NULL").withColumn("_rank", rank).where("_rank = 1").drop("_rank")
    return marked.where("_many IS NULL").unionByName(once).select(*docs.columns)
