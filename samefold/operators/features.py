"""The 18 pair features, as pure expressions or with fuzzy scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from samefold.functions import similarity, text

#: Order is part of the contract.
FEATURES = (
    "name_ratio", "name_partial_ratio", "name_token_sort_ratio", "name_token_set_ratio", "name_exact", "name_length_diff",
    "address_ratio", "address_partial_ratio", "address_token_set_ratio", "address_exact", "address_length_diff", "country_match",
    "shared_token_count", "shared_token_ratio", "address_number_match", "address_number_count", "candidate_score", "candidate_rank",
)


def with_records(pairs: DataFrame, s1: DataFrame, source: DataFrame) -> DataFrame:
    """Candidate pairs with both records."""
    a = s1.select(F.col("entity_id").alias("sid"), F.col("name").alias("n1"), F.col("address").alias("a1"), F.col("country").alias("c1"))
    b = source.select(F.col("entity_id").alias("cid"), F.col("name").alias("n2"), F.col("address").alias("a2"), F.col("country").alias("c2"))
    return pairs.join(a, "sid").join(b, "cid")


def _same(a: Column, b: Column) -> Column:
    return ((a == b) & (a != "")).cast("int")


def _length_ratio(a: Column, b: Column) -> Column:
    la, lb = F.length(a), F.length(b)
    return F.when((a == b) & (a != ""), 100.0).when((a == "") | (b == ""), 0.0).otherwise(F.least(la, lb) * 100.0 / F.greatest(la, lb))


def _list(c: Column) -> Column:
    """Tokens of the expression mode: an untrimmed split, where an empty text is one empty token."""
    return F.split(F.regexp_replace(c, r"\s+", " "), " ")


def _both(x: Column, y: Column) -> Column:
    return F.size(F.array_intersect(x, y))


def _jaccard(a: Column, b: Column) -> Column:
    x, y = _list(a), _list(b)
    return F.when(a == b, 100.0).otherwise(_both(x, y) * 100.0 / F.size(F.array_union(x, y)))


def _overlap(a: Column, b: Column) -> Column:
    x, y = _list(a), _list(b)
    return F.when(a == b, 100.0).otherwise(_both(x, y) * 100.0 / F.least(F.size(x), F.size(y)))


def _plain(df: DataFrame) -> DataFrame:
    """The features that both modes share."""
    n1, n2, a1, a2 = (F.col(c) for c in ("n1", "n2", "a1", "a2"))
    return df.withColumns({
        "name_exact": _same(n1, n2), "address_exact": _same(a1, a2), "country_match": _same(F.col("c1"), F.col("c2")),
        "name_length_diff": F.abs(F.length(n1) - F.length(n2)), "address_length_diff": F.abs(F.length(a1) - F.length(a2)),
    })


def proxy(pairs: DataFrame) -> DataFrame:
    """Mode D: expressions only; the score falls with the block rank.

    Token lists keep repeats in the denominators, and an empty text is one empty
    token: two empty texts agree, and an empty query name is part of any name.
    """
    n1, n2, a1, a2 = (F.col(c) for c in ("n1", "n2", "a1", "a2"))
    first = F.split_part(n1, F.lit(" "), F.lit(1))
    d1, d2 = text.first_number(a1, bounded=False), text.first_number(a2, bounded=False)
    x = _list(n1)
    both = _both(x, _list(n2))
    out = _plain(pairs).withColumns({
        "name_ratio": _length_ratio(n1, n2), "address_ratio": _length_ratio(a1, a2),
        "name_partial_ratio": F.when((n1 == n2) & (n1 != ""), 100.0).when(F.instr(n2, first) > 0, 80.0).otherwise(0.0),
        "name_token_sort_ratio": _jaccard(n1, n2), "name_token_set_ratio": _overlap(n1, n2),
        "address_partial_ratio": _overlap(a1, a2), "address_token_set_ratio": _overlap(a1, a2),
        "shared_token_count": F.least(F.lit(127), both), "shared_token_ratio": both / F.size(x),
        "address_number_match": _same(d1, d2), "address_number_count": _same(d1, d2),
        "candidate_score": (100 - F.col("block_rank")).cast("double"), "candidate_rank": F.col("block_rank"),
    })
    return out.select("sid", "cid", *FEATURES)


def candidate_score(df: DataFrame) -> Column:
    """Weighted blend of the base scores (P17; fixed values)."""
    w = {"name_token_set_ratio": 0.45, "name_ratio": 0.20, "name_partial_ratio": 0.15, "address_token_set_ratio": 0.10, "address_ratio": 0.05, "country_match": 5.0, "address_number_match": 3.0}
    out = F.lit(0.0)
    for c, x in w.items():
        out = out + F.col(c) * F.lit(x)
    return out


def reranked(df: DataFrame, k: int) -> DataFrame:
    """Rank by score (ties by block rank), then keep the best ``k`` (ties by id)."""
    by = W.partitionBy("sid")
    out = df.withColumn("candidate_score", candidate_score(df))
    out = out.withColumn("candidate_rank", F.row_number().over(by.orderBy(F.desc("candidate_score"), "block_rank")))
    return out.withColumn("_k", F.row_number().over(by.orderBy(F.desc("candidate_score"), "cid"))).where(F.col("_k") <= k).drop("_k")


def fuzzy(pairs: DataFrame, k=20) -> DataFrame:
    """Mode R: base scores for all candidates, the costly ones for the best ``k``."""
    n1, n2, a1, a2 = (F.col(c) for c in ("n1", "n2", "a1", "a2"))
    both = _both(text.numbers(a1), text.numbers(a2))
    x = F.array_distinct(text.words(n1))
    shared = _both(x, text.words(n2))
    base = _plain(pairs).withColumn("_s", similarity.scores({"name_ratio": ("ratio", n1, n2), "name_partial_ratio": ("partial_ratio", n1, n2), "name_token_set_ratio": ("token_set_ratio", n1, n2), "address_ratio": ("ratio", a1, a2), "address_token_set_ratio": ("token_set_ratio", a1, a2)}))
    base = base.select("*", "_s.*").drop("_s").withColumns({
        "shared_token_count": shared, "shared_token_ratio": F.when(F.size(x) > 0, shared / F.greatest(F.size(x), F.lit(1))).otherwise(0.0),
        "address_number_count": both, "address_number_match": (both > 0).cast("int"),
    })
    best = reranked(base, k).withColumn("_s", similarity.scores({"name_token_sort_ratio": ("token_sort_ratio", n1, n2), "address_partial_ratio": ("partial_ratio", a1, a2)}))
    return best.select("*", "_s.*").select("sid", "cid", *FEATURES)
