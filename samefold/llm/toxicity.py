"""Toxicity: a counterfactual-regularised classifier over words and word stems.

Labelled documents containing identity terms are paired with counterfactuals in
which every such term is swapped for the next of its group.  The fit adds a
penalty on the squared change of the log-odds between the two, so a neutral
mention of a group cannot carry weight of its own.

The fit uses a bounded sample of labelled rows that are not held out, at most
``FIT_ROWS`` of each label by hash order.  Features are selected from counts
that Spark aggregates over the sample; the driver holds ``FEATURES`` weights and
the sample's sparse vectors.  Every whole text is scored.

Defined results: null and empty texts get the score of the intercept; repeated
rows are each scored; labels are joined by id, of several labels of an id the greatest
and of several texts the least counts; a label row that is null is ignored; without labels of both kinds every score is the share of label 1 (0.5
with no label at all); an empty table gives an empty result.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from samefold.llm import common

FIT_ROWS = 4000
FEATURES = 4000
LEAST_DOCS = 4
STEMS = (3, 4, 5, 6, 7)
RIDGE, FAIRNESS, ROUNDS = 1.0, 1.0, 300
#: Terms that may stand for one another; swapped within their group.
IDENTITY_GROUPS = (
    ("women", "men"), ("woman", "man"), ("female", "male"), ("girls", "boys"), ("girl", "boy"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"), ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("black", "white", "asian", "latino", "arab"), ("gay", "straight", "lesbian", "bisexual"), ("transgender", "cisgender"),
    ("immigrants", "citizens", "refugees"), ("immigrant", "citizen", "refugee"), ("disabled", "able-bodied"), ("elderly", "young"),
    ("frau", "mann"), ("frauen", "männer"), ("mädchen", "jungen"), ("muslime", "christen", "juden"), ("schwule", "lesben"),
    ("femme", "homme"), ("femmes", "hommes"), ("filles", "garçons"), ("musulmans", "chrétiens", "juifs"), ("immigrés", "réfugiés"),
    ("mujer", "hombre"), ("mujeres", "hombres"), ("niñas", "niños"), ("musulmanes", "cristianos", "judíos"), ("inmigrantes", "refugiados"),
)
SWAP = {t: g[(i + 1) % len(g)] for g in IDENTITY_GROUPS for i, t in enumerate(g)}
EDGES = ".,;:!?*%$&#()[]{}<>\"'|-_/\\"


def swapped(text: str, swap: dict[str, str] = SWAP) -> str | None:
    """The text with every identity term swapped, or None without any."""
    hit = False

    def put(m):
        nonlocal hit
        other = swap.get(m[0].lower())
        if other is None:
            return m[0]
        hit = True
        return other.capitalize() if m[0][:1].isupper() else other

    out = re.sub(r"[^\W\d_]+(?:-[^\W\d_]+)*", put, text)
    return out if hit else None


def _terms(texts: pa.Array):
    """(distinct words, flat word codes, bounds of each text)."""
    plain = pc.utf8_lower(pc.replace_substring(texts.fill_null(""), "\n", " "))
    split = pc.split_pattern(plain, " ")
    coded = split.flatten().dictionary_encode()
    words = pc.utf8_trim(coded.dictionary, EDGES).to_pylist()
    return words, coded.indices.to_numpy(), split.offsets.to_numpy() - split.offsets[0].as_py()


def word_features(word: str) -> list[str]:
    if len(word) < 2:
        return []
    return [word + "$", *(word[:n] for n in STEMS if n < len(word))]


def feature_sets(texts: pa.Array) -> list[set[str]]:
    words, at, bounds = _terms(texts)
    known = [word_features(w) for w in words]
    return [set().union(*(known[k] for k in np.unique(at[a:b]).tolist())) for a, b in zip(bounds, bounds[1:])]


def sample(docs: DataFrame, labels: DataFrame, label_col: str, id_col="doc_id", text_col="text", rows=FIT_ROWS) -> DataFrame:
    """(doc_id, text, y): the first ``rows`` of each label by hash, none held out."""
    y = labels.select(F.col("doc_id").cast("long").alias("_l"), F.col(label_col).cast("int").alias("y")).where(F.col("y").isin(0, 1) & F.col("_l").isNotNull())
    y = y.where(~common.held_out(F.col("_l"))).groupBy("_l").agg(F.max("y").alias("y"))
    order = F.xxhash64("_l")
    picked = y.where("y = 1").orderBy(order, "_l").limit(rows).unionByName(y.where("y = 0").orderBy(order, "_l").limit(rows))
    totals = {r.y: r.n for r in y.groupBy("y").agg(F.count("*").alias("n")).collect()}
    got = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    out = got.join(F.broadcast(picked), F.col("doc_id") == F.col("_l")).select("doc_id", "text", "y")  # at most 2 * rows ids
    return common.staged(out.groupBy("doc_id").agg(F.min("text").alias("text"), F.max("y").alias("y")), "sample"), totals


def select_features(rows: DataFrame, features=FEATURES) -> list[str]:
    """The features whose document counts differ most between the labels."""

    def explode(batches):
        for b in batches:
            fs, ys = [], []
            for s, y in zip(feature_sets(b.column(0)), b.column(1).to_pylist()):
                fs.extend(s)
                ys.extend([y] * len(s))
            yield pa.RecordBatch.from_arrays([pa.array(fs, pa.string()), pa.array(ys, pa.int32())], ["feature", "y"])

    n1, n0 = (rows.agg(F.sum("y").alias("a"), F.sum(1 - F.col("y")).alias("b")).first()) or (0, 0)
    if not n1 or not n0:
        return []
    counts = rows.select("text", "y").mapInArrow(common.tidied(explode), "feature string, y int").groupBy("feature").agg(F.sum("y").alias("a"), F.sum(1 - F.col("y")).alias("b"))
    counts = counts.where((F.col("a") + F.col("b") >= LEAST_DOCS))
    p1, p0 = (F.col("a") + 0.5) / (n1 + 1.0), (F.col("b") + 0.5) / (n0 + 1.0)
    # signed root of the two-sample score statistic; toxic cues are rare words
    pooled = (F.col("a") + F.col("b")) / float(n1 + n0)
    gain = F.abs(p1 - p0) / F.sqrt(pooled * (1 - pooled) + 1e-4)
    return [r.feature for r in counts.orderBy(gain.desc(), "feature").limit(features).select("feature").collect()]


def vectors(texts: pa.Array, index: dict[str, int], memo: dict | None = None) -> list[np.ndarray]:
    """Indexes of the known features present in each text."""
    words, at, bounds = _terms(texts)
    memo = {} if memo is None else memo
    known = []
    for w in words:
        got = memo.get(w)
        if got is None:
            got = memo[w] = tuple(index[f] for f in word_features(w) if f in index)
        known.append(got)
    useful = np.fromiter(map(bool, known), bool, len(known))
    out = []
    for a, b in zip(bounds, bounds[1:]):
        part = at[a:b]
        hit = np.unique(part[useful[part]])
        out.append(np.unique(np.fromiter((i for k in hit.tolist() for i in known[k]), np.int64)))
    return out


def fit(rows: DataFrame, totals: dict[int, int], names: list[str], swap=SWAP, ridge=RIDGE, fairness=FAIRNESS, rounds=ROUNDS) -> np.ndarray:
    """Weights, the intercept last, by accelerated gradient steps."""
    index = {f: i for i, f in enumerate(names)}
    share = rows.sparkSession.sparkContext.broadcast(index)

    def encode(batches):
        for b in batches:
            texts = b.column(0)
            other = [swapped(t or "", swap) for t in texts.to_pylist()]
            xs = vectors(texts, share.value)
            zs = vectors(pa.array(other, pa.string()), share.value)
            yield pa.RecordBatch.from_arrays([pa.array(xs, pa.list_(pa.int64())), pa.array([z if o is not None else None for z, o in zip(zs, other)], pa.list_(pa.int64())), b.column(1)], ["x", "z", "y"])

    data = rows.orderBy("doc_id").select("text", "y").mapInArrow(common.tidied(encode), "x array<long>, z array<long>, y int").collect()
    m = len(names)
    y = np.asarray([r.y for r in data], float)
    ri = np.repeat(np.arange(len(data)), [len(r.x) for r in data])
    ci = np.concatenate([np.asarray(r.x, np.int64) for r in data] or [np.zeros(0, np.int64)])
    pairs = [(set(r.x), set(r.z)) for r in data if r.z is not None and set(r.x) != set(r.z)]
    di, dc, dv = [], [], []
    for k, (x, z) in enumerate(pairs):
        for f in x ^ z:
            di.append(k)
            dc.append(f)
            dv.append(1.0 if f in x else -1.0)
    di, dc, dv = np.asarray(di, int), np.asarray(dc, int), np.asarray(dv)
    n1, n0 = max(1.0, y.sum()), max(1.0, (1 - y).sum())
    w = np.where(y == 1, totals.get(1, 0) / n1, totals.get(0, 0) / n0)
    w *= len(y) / w.sum()
    beta = np.zeros(m + 1)
    beta[m] = np.log(totals.get(1, 1) / max(1, totals.get(0, 1)))
    # Adagrad steps: scale-free for rare and frequent features alike
    seen = np.full(m + 1, 1e-8)
    for _ in range(rounds):
        logit = np.bincount(ri, beta[ci], len(y)) + beta[m]
        err = w * (1 / (1 + np.exp(-np.clip(logit, -40, 40))) - y)
        grad = np.append(np.bincount(ci, err[ri], m)[:m] + ridge * beta[:m], err.sum())
        if len(pairs):
            gap = np.bincount(di, dv * beta[dc], len(pairs))
            grad[:m] += 2 * fairness * np.bincount(dc, dv * gap[di], m)[:m]
        seen += grad * grad
        beta -= 0.5 * grad / np.sqrt(seen)
    return beta


def score(docs: DataFrame, names: list[str], beta: np.ndarray, id_col="doc_id", text_col="text") -> DataFrame:
    """(doc_id, score) of every whole text."""
    common.configure(docs.sparkSession)
    share = docs.sparkSession.sparkContext.broadcast(({f: i for i, f in enumerate(names)}, beta))

    def run(batches):
        index, weights = share.value
        memo: dict = {}
        for b in batches:
            if len(memo) > 200_000:
                memo.clear()
            logit = np.asarray([weights[x].sum() for x in vectors(b.column(1), index, memo)]) + weights[-1]
            p = 1 / (1 + np.exp(-np.clip(logit, -40, 40)))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(p, pa.float64())], ["doc_id", "score"])

    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return src.mapInArrow(common.tidied(run), "doc_id long, score double")


def model(docs: DataFrame, labels: DataFrame, label_col="toxic", id_col="doc_id", text_col="text") -> tuple[list[str], np.ndarray]:
    common.configure(docs.sparkSession)
    rows, totals = sample(docs, labels, label_col, id_col, text_col)
    names = select_features(rows)
    if not names:
        n = sum(totals.values())
        p = min(max(totals.get(1, 0) / n if n else 0.5, 1e-6), 1 - 1e-6)
        return [], np.asarray([np.log(p / (1 - p))])
    return names, fit(rows, totals, names)


def classify(docs: DataFrame, labels: DataFrame, threshold=0.5, id_col="doc_id", text_col="text") -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document."""
    out = score(docs, *model(docs, labels, "toxic", id_col, text_col), id_col, text_col)
    return out.select("doc_id", common.held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold=0.5, id_col="doc_id", text_col="text") -> DataFrame:
    """The rows of ``docs`` whose own text scores below ``threshold``."""
    names, beta = model(docs, labels, "toxic", id_col, text_col)
    common.configure(docs.sparkSession)
    share = docs.sparkSession.sparkContext.broadcast(({f: i for i, f in enumerate(names)}, beta))
    at = docs.columns.index(text_col)

    def run(batches):
        index, weights = share.value
        memo: dict = {}
        for b in batches:
            if len(memo) > 200_000:
                memo.clear()
            logit = np.asarray([weights[x].sum() for x in vectors(b.column(at), index, memo)]) + weights[-1]
            yield b.filter(pa.array(1 / (1 + np.exp(-np.clip(logit, -40, 40))) < threshold))

    return docs.mapInArrow(common.tidied(run), docs.schema)
