"""Quality by nearest-neighbour voting in a latent-semantic space.

Terms are hashed byte trigrams of the text, case and symbols included, and a
few structural ones (shares of capitals, digits and symbols, repeated lines and
words, word lengths).  A bounded sample of labelled rows that are not held out,
at most ``FIT_ROWS`` of each label by hash order, gives the term weights, the
truncated singular vectors and the labelled vectors, all of fixed size and
broadcast.  Every document's whole text is projected, its cosines with all
labelled vectors are computed exactly, block by block, and its nearest
neighbours' labels are averaged, weighted by similarity and by how much of its
label the sample holds.

Defined results: null and empty texts, which have no vector, score the share of
label 1; all labelled vectors as near as the last neighbour vote, so ties leave nothing
to order; repeated rows are each scored; an id with several texts is fitted on the least; null labels are ignored; with no label
at all every score is 0.5; an empty table gives an empty result; other columns
are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from samefold.llm import common
from samefold.llm.toxicity import sample

FIT_ROWS = 2000
BUCKETS = 2048
RANK = 64
NEIGHBOURS = 15
SHARPNESS = 8
BLOCK = 256
N_SHAPE = 12
#: Weight of the structural terms against the trigrams.
SHAPE_WEIGHT = 1.0


def shape(text: str) -> list[float]:
    """Structural terms, each in [0, 1]."""
    n = max(1, len(text))
    words = text.split()
    lines = [x for x in text.split("\n") if x]
    nw, nl = max(1, len(words)), max(1, len(lines))
    return [
        sum(map(str.isupper, words)) / nw,
        1 - len(set(words)) / nw if nw > 1 else 0.0,
        1 - len(set(lines)) / nl,
        min(1.0, (n / nw) / 20),
        (text.count("*") + text.count("#") + text.count("$") + text.count("%") + text.count("&")) / n * 4,
        text.count("!") / n * 4,
        text.count("|") / n * 8,
        sum(map(text.count, "0123456789")) / n * 4,
        min(1.0, nl / nw),
        (text.count(".") + text.count(",")) / n * 8,
        min(1.0, np.log1p(nw) / 10),
        (text.count("<") + text.count(">") + text.count("{") + text.count("}") + text.count("/")) / n * 4,
    ]


def terms(texts: list[str]) -> np.ndarray:
    """Root term frequencies of the texts, one row each."""
    out = np.zeros((len(texts), BUCKETS + N_SHAPE), np.float32)
    for i, t in enumerate(texts):
        raw = np.frombuffer((t or "").encode("utf-8", "replace"), np.uint8).astype(np.uint32)
        if len(raw) >= 3:
            h = (raw[:-2] * 0x9E3779B1 + raw[1:-1] * 0x85EBCA6B + raw[2:] * 0xC2B2AE35).astype(np.uint32)
            h ^= h >> np.uint32(15)
            out[i, :BUCKETS] = np.sqrt(np.bincount(h % BUCKETS, minlength=BUCKETS) / len(h))
        if t:
            out[i, BUCKETS:] = np.sqrt(np.clip(shape(t), 0, 1)) * SHAPE_WEIGHT
    return out


def fit(x: np.ndarray, rank=RANK, seed=7) -> tuple[np.ndarray, np.ndarray]:
    """(mean, projection): randomised truncated SVD of the centred terms."""
    mean = x.mean(axis=0)
    c = (x - mean).astype(np.float64)
    rank = min(rank, *c.shape)
    rng = np.random.default_rng(seed)
    q = np.linalg.qr(c @ rng.standard_normal((c.shape[1], min(c.shape[0], rank + 16))))[0]
    for _ in range(4):
        q = np.linalg.qr(c @ (c.T @ q))[0]
    v = np.linalg.svd(q.T @ c, full_matrices=False)[2][:rank]
    return mean, v.T.astype(np.float32)


def unit(x: np.ndarray) -> np.ndarray:
    n = np.linalg.norm(x, axis=1, keepdims=True)
    return np.divide(x, n, out=np.zeros_like(x), where=n > 1e-12)


def vote(z: np.ndarray, labelled: np.ndarray, y: np.ndarray, weight: np.ndarray, prior: float, k=NEIGHBOURS) -> np.ndarray:
    """Similarity-weighted share of label 1 among the ``k`` nearest, and all as near as the last of them."""
    out = np.empty(len(z))
    k = min(k, len(y))
    for a in range(0, len(z), BLOCK):
        cos = z[a : a + BLOCK] @ labelled.T
        last = np.partition(cos, -k, axis=1)[:, -k]
        row, near = np.nonzero(cos >= last[:, None])
        w = np.clip(cos[row, near], 0, 1).astype(float) ** SHARPNESS * weight[near]
        s, one = np.bincount(row, w, len(cos)), np.bincount(row, w * y[near], len(cos))
        out[a : a + BLOCK] = np.where(s > 0, one / np.where(s > 0, s, 1), prior)
    return np.clip(out, 0, 1)


def model(docs: DataFrame, labels: DataFrame, id_col="doc_id", text_col="text"):
    """(mean, projection, labelled vectors, labels, weights, prior) or the prior alone."""
    common.configure(docs.sparkSession)
    rows, totals = sample(docs, labels, "quality", id_col, text_col, FIT_ROWS)

    def encode(batches):
        for b in batches:
            texts = b.column(0).to_pylist()
            yield pa.RecordBatch.from_arrays([pa.array([v.tobytes() for v in terms(texts).astype(np.float16)], pa.binary()), b.column(1), b.column(2)], ["x", "y", "doc_id"])

    got = rows.select("text", "y", "doc_id").mapInArrow(common.tidied(encode), "x binary, y int, doc_id long").orderBy("doc_id").collect()
    n = sum(totals.values())
    prior = totals.get(1, 0) / n if n else 0.5
    if len(got) < 2:
        return None, prior
    x = np.stack([np.frombuffer(r.x, np.float16) for r in got]).astype(np.float32)
    y = np.asarray([r.y for r in got], np.float64)
    mean, v = fit(x)
    z = unit((x - mean) @ v).astype(np.float32)
    weight = np.where(y == 1, totals.get(1, 0) / max(1, y.sum()), totals.get(0, 0) / max(1, (1 - y).sum()))
    return (mean, v, z, y, weight), prior


def score(docs: DataFrame, labels: DataFrame, threshold=0.3, id_col="doc_id", text_col="text") -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document."""
    fitted, prior = model(docs, labels, id_col, text_col)
    share = docs.sparkSession.sparkContext.broadcast(fitted)  # about 2 * FIT_ROWS * RANK numbers

    def run(batches):
        for b in batches:
            texts = b.column(1).to_pylist()
            p = np.full(len(texts), prior)
            if share.value is not None:
                mean, v, z, y, weight = share.value
                for a in range(0, len(texts), BLOCK):
                    part = texts[a : a + BLOCK]
                    p[a : a + BLOCK] = vote(unit((terms(part) - mean) @ v), z, y, weight, prior)
                    p[a : a + BLOCK][[not t for t in part]] = prior
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(p, pa.float64())], ["doc_id", "score"])

    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    out = src.mapInArrow(common.tidied(run), "doc_id long, score double")
    return out.select("doc_id", common.held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
