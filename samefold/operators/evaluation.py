"""Recall, precision and validation of candidates and matches (E1-E21, VC1-VC15)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from samefold.functions import text
from samefold.operators.matching import f_beta
from samefold.sources.staging import staged


def per_entity(truth: DataFrame, found: DataFrame) -> DataFrame:
    """(sid, n_true, n_found, n_hit) of every S1 record of either table."""
    t = truth.select("sid", "cid").distinct().withColumn("t", F.lit(1))
    p = found.select("sid", "cid").distinct().withColumn("p", F.lit(1))
    both = t.join(p, ["sid", "cid"], "full_outer")
    return both.groupBy("sid").agg(F.count("t").alias("n_true"), F.count("p").alias("n_found"), F.sum(F.when(F.col("t").isNotNull() & F.col("p").isNotNull(), 1).otherwise(0)).alias("n_hit"))


def blocking_recall(truth: DataFrame, found: DataFrame) -> DataFrame:
    """Pair and entity recall, complete and partial recovery, list sizes."""
    e = per_entity(truth, found)
    true = F.col("n_true") > 0
    n = F.sum(F.when(true, 1).otherwise(0))
    share = lambda c: F.sum(F.when(true & c, 1).otherwise(0)) / F.greatest(n, F.lit(1))
    return e.agg(n.cast("long").alias("entities"), (F.sum("n_hit") / F.greatest(F.sum("n_true"), F.lit(1))).alias("pair_recall"), share(F.col("n_hit") > 0).alias("entity_recall"),
                 share(F.col("n_hit") == F.col("n_true")).alias("all_match_rate"), F.sum(F.when(true & (F.col("n_hit") > 0) & (F.col("n_hit") < F.col("n_true")), 1).otherwise(0)).cast("long").alias("partial"),
                 F.avg("n_found").alias("avg_candidates"), F.max("n_found").cast("long").alias("max_candidates"))


def pair_metrics(truth: DataFrame, found: DataFrame, s1: DataFrame | None = None) -> DataFrame:
    """Micro scores, entity scores and exact-match rate.

    With ``s1`` the exact-match rate is over all its records, a right empty answer included.
    """
    e = per_entity(truth, found)
    if s1 is not None:
        e = s1.select(F.col("entity_id").alias("sid")).join(e, "sid", "full_outer").fillna(0)
    tp, fp, fn = F.sum("n_hit"), F.sum(F.col("n_found") - F.col("n_hit")), F.sum(F.col("n_true") - F.col("n_hit"))
    any_hit = F.sum((F.col("n_hit") > 0).cast("int"))
    any_fp = F.sum((F.col("n_found") > F.col("n_hit")).cast("int"))
    any_fn = F.sum((F.col("n_true") > F.col("n_hit")).cast("int"))
    exact = F.avg(((F.col("n_hit") == F.col("n_true")) & (F.col("n_hit") == F.col("n_found"))).cast("double"))
    g = e.agg(tp.cast("long").alias("tp"), fp.cast("long").alias("fp"), fn.cast("long").alias("fn"), any_hit.alias("h"), any_fp.alias("x"), any_fn.alias("y"), exact.alias("exact_match_rate"))
    div = lambda a, b: F.when(b > 0, a / F.greatest(b, F.lit(1))).otherwise(0.0)
    p, r = div(F.col("tp"), F.col("tp") + F.col("fp")), div(F.col("tp"), F.col("tp") + F.col("fn"))
    return g.select("tp", "fp", "fn", p.alias("precision"), r.alias("recall"), f_beta(p, r, 1.0).alias("f1"), f_beta(p, r).alias("f05"),
                    div(F.col("h"), F.col("h") + F.col("x")).alias("entity_precision"), div(F.col("h"), F.col("h") + F.col("y")).alias("entity_recall"), "exact_match_rate")


def macro_f05(s1: DataFrame, truth: DataFrame, found: DataFrame, empty_empty=0.0) -> DataFrame:
    """Mean F0.5 over S1; ``empty_empty`` scores a right empty answer."""
    e = s1.select(F.col("entity_id").alias("sid")).join(per_entity(truth, found), "sid", "left").fillna(0)
    p = F.when(F.col("n_found") > 0, F.col("n_hit") / F.greatest("n_found", F.lit(1))).otherwise(0.0)
    r = F.when(F.col("n_true") > 0, F.col("n_hit") / F.greatest("n_true", F.lit(1))).otherwise(1.0)
    f = F.when((F.col("n_true") == 0) & (F.col("n_found") == 0), F.lit(empty_empty)).otherwise(f_beta(p, r))
    return e.agg(F.count("*").alias("entities"), F.avg(f).alias("macro_f05"))


def best_possible_f05(recall: float) -> float:
    """F0.5 at precision 1."""
    return 1.25 * recall / (0.25 + recall) if recall else 0.0


def recall_ceiling(truth: DataFrame, found: DataFrame) -> DataFrame:
    """(pair_recall, best_f05): what a faultless model could reach on these candidates."""
    r = F.col("pair_recall")
    return blocking_recall(truth, found).select("pair_recall", F.when(r > 0, 1.25 * r / (0.25 + r)).otherwise(0.0).alias("best_f05"))


def percentiles(df: DataFrame, value: str, percents: list[int], by: tuple[str, ...] = ()) -> DataFrame:
    """(*by, p10, ...): exact percentiles, interpolated between neighbours, nulls left out.

    Distinct values are counted, dealt by range and staged; running counts are
    taken inside each range on top of the counts of the ranges before it, so no
    task holds all values.
    """
    spark = df.sparkSession
    counts = df.where(F.col(value).isNotNull()).groupBy(*by, F.col(value).alias("v")).agg(F.count("*").alias("n"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    counts = staged(counts.repartitionByRange(parts, *by, "v").withColumn("part", F.spark_partition_id()), "counts")
    totals = counts.groupBy(*by, "part").agg(F.sum("n").alias("t"))
    total = W.partitionBy(*by) if by else W.partitionBy(F.lit(0))
    before = total.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    totals = totals.select(*by, "part", F.coalesce(F.sum("t").over(before), F.lit(0)).alias("before"), F.sum("t").over(total).alias("total"))  # one row a range and group
    same = reduce(lambda x, y: x & y, [F.col(f"c.{k}").eqNullSafe(F.col(f"t.{k}")) for k in (*by, "part")])
    ranked = counts.alias("c").join(totals.alias("t"), same).select(*[F.col(f"c.{k}").alias(k) for k in by], "c.part", "v", "n", "before", "total")
    last = F.col("before") + F.sum("n").over(W.partitionBy(*by, "part").orderBy("v").rowsBetween(W.unboundedPreceding, 0)) - 1
    ranked = ranked.withColumn("last", last).withColumn("first", F.col("last") - F.col("n") + 1)

    def at(place):  # the value on a whole place
        return F.max(F.when((F.col("first") <= place) & (place <= F.col("last")), F.col("v")))

    out = []
    for q in percents:
        place = F.lit(q / 100) * (F.col("total") - 1)
        low, high = at(F.floor(place)), at(F.ceil(place))
        share = F.max(place - F.floor(place))
        out.append(F.when(low == high, low.cast("double")).otherwise(low * (1 - share) + high * share).alias(f"p{q}"))
    return ranked.groupBy(*by).agg(*out)


def rule_contribution(truth: DataFrame, hits: DataFrame) -> DataFrame:
    """(rule, recovered): true pairs that each rule reaches."""
    return truth.distinct().join(hits, ["sid", "cid"]).groupBy("rule").agg(F.count("*").alias("recovered"))


def first_rule(truth: DataFrame, hits: DataFrame, priority: list[str]) -> DataFrame:
    """(rule, pairs): the first rule in order that reaches each true pair."""
    order = F.create_map(*[F.lit(x) for i, r in enumerate(priority) for x in (r, i)])
    first = truth.distinct().join(hits, ["sid", "cid"]).groupBy("sid", "cid").agg(F.min_by("rule", F.try_element_at(order, F.col("rule"))).alias("rule"))
    return first.groupBy("rule").agg(F.count("*").alias("pairs"))


def missed_by(truth: DataFrame, candidates: DataFrame, predicted: DataFrame) -> DataFrame:
    """Counts of missed true pairs by the stage that lost them."""
    c = candidates.select("sid", "cid").distinct().withColumn("c", F.lit(1))
    p = predicted.select("sid", "cid").distinct().withColumn("p", F.lit(1))
    stage = F.when(F.col("p").isNotNull(), "found").when(F.col("c").isNotNull(), "model").otherwise("blocking")
    return truth.distinct().join(c, ["sid", "cid"], "left").join(p, ["sid", "cid"], "left").groupBy(stage.alias("stage")).agg(F.count("*").alias("pairs"))


def profile(pairs: DataFrame) -> DataFrame:
    """Characteristics of pairs joined with their records."""
    t1, t2 = text.tokens(F.col("n1")), text.tokens(F.col("n2"))
    a1, a2 = text.tokens(F.col("a1"), 3), text.tokens(F.col("a2"), 3)
    d1, d2 = text.first_number(F.col("a1")), text.first_number(F.col("a2"))
    eq = lambda x, y: (x == y) & (x != "")
    checks = {
        "same_country": eq(F.col("c1"), F.col("c2")), "same_name": eq(F.col("n1"), F.col("n2")), "same_address": eq(F.col("a1"), F.col("a2")),
        "same_first": eq(text.token_at(t1, 1), text.token_at(t2, 1)), "same_second": eq(text.token_at(t1, 2), text.token_at(t2, 2)), "same_last": eq(text.token_at(t1, -1), text.token_at(t2, -1)),
        "same_prefix3": eq(text.prefix(F.col("n1"), 3), text.prefix(F.col("n2"), 3)), "same_prefix5": eq(text.prefix(F.col("n1"), 5), text.prefix(F.col("n2"), 5)), "same_suffix4": eq(text.suffix(F.col("n1"), 4), text.suffix(F.col("n2"), 4)),
        "same_number": eq(d1, d2), "share_name_token": F.arrays_overlap(t1, t2), "share_address_token": F.arrays_overlap(a1, a2),
    }
    reach = reduce(lambda x, y: x | y, [v for k, v in checks.items() if k != "same_country"])
    return pairs.agg(F.count("*").alias("pairs"), *[F.coalesce(F.sum(v.cast("int")), F.lit(0)).cast("long").alias(k) for k, v in checks.items()], F.coalesce(F.sum(reach.cast("int")), F.lit(0)).cast("long").alias("reachable"))


def recovery_curve(truth: DataFrame, ranked: DataFrame, ks: list[int], rank="block_rank") -> DataFrame:
    """(k, recovered) at every cut-off."""
    hit = truth.distinct().join(ranked, ["sid", "cid"])
    row = hit.agg(*[F.coalesce(F.sum((F.col(rank) <= k).cast("int")), F.lit(0)).cast("long").alias(str(k)) for k in ks])
    return row.select(F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.col(str(k)).alias("recovered")) for k in ks])).alias("x")).select("x.*")


def best_second(scored: DataFrame) -> DataFrame:
    """Best and second probability of each S1 record and their distance."""
    w = W.partitionBy("sid").orderBy(F.desc("probability"), "cid")
    r = scored.withColumn("r", F.row_number().over(w)).where("r <= 2")
    g = r.groupBy("sid").agg(F.max(F.when(F.col("r") == 1, F.col("probability"))).alias("best"), F.coalesce(F.max(F.when(F.col("r") == 2, F.col("probability"))), F.lit(0.0)).alias("second"))
    return g.withColumn("margin", F.col("best") - F.col("second"))


def validate(s1: DataFrame, matches: DataFrame, candidates: DataFrame) -> DataFrame:
    """(check, violations) of a result with ``matched_entity_ids`` (VC1-VC15).

    Both tables are read by several checks and staged first.
    """
    matches, candidates = staged(matches, "matches"), staged(candidates.select("sid", "cid"), "candidates")
    ids = s1.select(F.col("entity_id").alias("sid"))
    m = matches.select("sid", F.explode(F.filter(F.split("matched_entity_ids", ","), lambda x: x != "")).alias("cid"))
    c = candidates.select("sid", "cid")
    one = lambda df, name: df.agg(F.count("*").alias("violations")).select(F.lit(name).alias("check"), "violations")
    return reduce(DataFrame.unionByName, [
        one(matches.groupBy("sid").count().where("count > 1"), "duplicate_s1"),
        one(ids.join(matches, "sid", "left_anti"), "missing_s1"), one(matches.join(ids, "sid", "left_anti"), "unknown_s1"),
        one(matches.where(~F.col("sid").rlike(r"^S1-\d+$")), "malformed_s1"), one(m.where(~F.col("cid").rlike(r"^S[23]-\d+$")), "malformed_match"),
        one(m.groupBy("sid", "cid").count().where("count > 1"), "duplicate_pair"), one(m.join(c, ["sid", "cid"], "left_anti"), "match_not_candidate"),
        one(matches.where(F.col("sid").rlike(r"^\d+$")), "index_column"),
    ])


def diff(old: DataFrame, new: DataFrame) -> DataFrame:
    """(kind, pairs): kept, added and removed between two results (VC12, U1, U2)."""
    a = old.select("sid", "cid").distinct().withColumn("a", F.lit(1))
    b = new.select("sid", "cid").distinct().withColumn("b", F.lit(1))
    kind = F.when(F.col("a").isNull(), "added").when(F.col("b").isNull(), "removed").otherwise("kept")
    return a.join(b, ["sid", "cid"], "full_outer").groupBy(kind.alias("kind")).agg(F.count("*").alias("pairs"))


def audit(df: DataFrame) -> DataFrame:
    """(column, rows, empty, empty_pct, distinct_values, duplicates) of every column."""
    parts = []
    for c in df.columns:
        v = F.coalesce(F.col(c).cast("string"), F.lit(""))
        parts += [F.sum((F.trim(v) == "").cast("int")).alias(f"e_{c}"), F.countDistinct(v).alias(f"d_{c}")]
    row = df.agg(F.count("*").alias("rows"), *parts)
    cols = F.array(*[F.struct(F.lit(c).alias("column"), F.coalesce(F.col(f"e_{c}"), F.lit(0)).cast("long").alias("empty"), F.col(f"d_{c}").alias("distinct_values")) for c in df.columns])
    pct = F.when(F.col("rows") > 0, F.col("x.empty") * 100.0 / F.greatest("rows", F.lit(1))).otherwise(0.0)
    return row.select("rows", F.explode(cols).alias("x")).select("x.column", "rows", "x.empty", F.round(pct, 6).alias("empty_pct"), "x.distinct_values", (F.col("rows") - F.col("x.distinct_values")).alias("duplicates"))


def match_histogram(s1: DataFrame, truth: DataFrame) -> DataFrame:
    """(matches, entities) with 4 standing for more."""
    n = truth.distinct().groupBy("sid").agg(F.count("*").alias("n"))
    each = s1.select(F.col("entity_id").alias("sid")).join(n, "sid", "left").select(F.least(F.lit(4), F.coalesce("n", F.lit(0))).cast("long").alias("matches"))
    return each.groupBy("matches").agg(F.count("*").alias("entities"))


def recall_averages(s1: DataFrame, truth: DataFrame, found: DataFrame) -> DataFrame:
    """True pairs per S1 record with truth, recovered and found ones per S1 record."""
    e = s1.select(F.col("entity_id").alias("sid")).join(per_entity(truth, found), "sid", "left").fillna(0)
    return e.agg((F.sum("n_true") / F.greatest(F.sum((F.col("n_true") > 0).cast("int")), F.lit(1))).alias("avg_truth"), F.avg("n_hit").alias("avg_recovered"), F.avg("n_found").alias("avg_candidates"),
                 F.max("n_found").cast("long").alias("max_candidates"), F.sum((F.col("n_found") == 0).cast("long")).alias("zero_candidates"), F.sum("n_found").cast("long").alias("total_candidates"))


def compared(truth: DataFrame, old: DataFrame, new: DataFrame) -> DataFrame:
    """(metric, baseline, other, delta) of two candidate tables."""
    def long(df, name):
        cols = [c for c in df.columns]
        return df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias(name)) for c in cols])).alias("x")).select("x.*")

    a, b = long(blocking_recall(truth, old), "baseline"), long(blocking_recall(truth, new), "other")
    return a.join(b, "metric").withColumn("delta", F.col("other") - F.col("baseline"))


def stage_recall(truth: DataFrame, rows: DataFrame) -> DataFrame:
    """What of the truth reached a stage that holds pairs, such as features."""
    t = truth.select("sid", "cid").distinct()
    hit = t.join(rows.select("sid", "cid").distinct().withColumn("p", F.lit(1)), ["sid", "cid"], "left").groupBy("sid").agg(F.count("*").alias("n_true"), F.count("p").alias("n_hit"))
    n = F.greatest(F.count("*"), F.lit(1))
    some, whole = F.col("n_hit") > 0, F.col("n_hit") >= F.col("n_true")
    got = hit.agg(F.coalesce(F.sum("n_true"), F.lit(0)).alias("truth_pairs"), F.coalesce(F.sum("n_hit"), F.lit(0)).alias("recovered_pairs"), (F.sum("n_hit") / F.greatest(F.sum("n_true"), F.lit(1))).alias("pair_recall"),
                  (F.sum(some.cast("int")) / n).alias("entity_recall"), (F.sum(whole.cast("int")) / n).alias("all_match_rate"), F.coalesce(F.sum((some & ~whole).cast("long")), F.lit(0)).alias("partial"))
    return rows.agg(F.count("*").alias("stage_rows")).join(got, F.lit(True))


def probability_by_truth(scored: DataFrame) -> DataFrame:
    """Spread of the probability of true and of other pairs."""
    c = F.col("probability")
    scored = staged(scored.select("label", "probability"), "scored")  # counted, then ranked
    plain = scored.groupBy("label").agg(F.count(c).alias("n"), F.min(c).alias("least"), F.max(c).alias("greatest"), F.avg(c).alias("mean"))
    return plain.join(percentiles(scored, "probability", [25, 50, 75], ("label",)), "label", "left")


def missed_sample(truth: DataFrame, hits: DataFrame, n=20) -> DataFrame:
    """The first ``n`` true pairs that no rule reaches."""
    return truth.select("sid", "cid").distinct().join(hits.select("sid", "cid"), ["sid", "cid"], "left_anti").orderBy("sid", "cid").limit(n)


def column_diff(df: DataFrame, expected: list[str]) -> DataFrame:
    """(column, state): missing, unexpected or present, and in its place or not (F13, VC1)."""
    rows = [(c, "missing", False) for c in expected if c not in df.columns]
    rows += [(c, "present" if c in expected else "unexpected", c in expected and df.columns.index(c) == expected.index(c)) for c in df.columns]
    return df.sparkSession.createDataFrame(rows, "column string, state string, in_place boolean")


def result_summary(s1: DataFrame, matches: DataFrame, candidates: DataFrame) -> DataFrame:
    """Counts of a result and of its candidate lists (VC9, VC10, VC11)."""
    ids = F.filter(F.split("matched_entity_ids", ","), lambda x: x != "")
    kind = lambda p: F.size(F.filter(ids, lambda x: x.rlike(p)))
    m = matches.select(kind(r"^S2-\d+$").alias("s2"), kind(r"^S3-\d+$").alias("s3"), F.size(ids).alias("n"))
    m = m.agg(F.count("*").alias("rows"), F.sum("s2").alias("s2_ids"), F.sum("s3").alias("s3_ids"), F.sum(F.col("n") - F.col("s2") - F.col("s3")).alias("malformed_ids"), F.sum((F.col("n") > 0).cast("long")).alias("matched_s1"), (F.avg((F.col("n") > 0).cast("double")) * 100).alias("match_coverage"))
    n = s1.select(F.col("entity_id").alias("sid")).join(candidates.groupBy("sid").agg(F.count("*").alias("n")), "sid", "left").fillna(0)
    n = n.agg(F.min("n").alias("min_candidates"), F.avg("n").alias("avg_candidates"), F.max("n").alias("max_candidates"), F.sum((F.col("n") == 0).cast("long")).alias("zero_candidates"))
    return m.join(n, F.lit(True))  # one row each


def lookup_completeness(wanted: DataFrame, source: DataFrame) -> DataFrame:
    """(requested, found, missing) ids of a lookup (VC14, J4)."""
    asked = wanted.select(F.col("cid").alias("entity_id")).distinct()
    got = asked.join(source.select("entity_id", F.lit(1).alias("p")).distinct(), "entity_id", "left")
    return got.agg(F.count("*").alias("requested"), F.count("p").alias("found"), (F.count("*") - F.count("p")).alias("missing"))


def alignment(s1: DataFrame, other: DataFrame) -> DataFrame:
    """How two tables agree on their S1 ids: repeats, and ids of one side only (VC15, J14)."""
    a = s1.select(F.col("entity_id").alias("sid")).groupBy("sid").agg(F.count("*").alias("a"))
    b = other.groupBy("sid").agg(F.count("*").alias("b"))
    g = a.join(b, "sid", "full_outer")
    n = lambda c: F.coalesce(F.sum(c.cast("long")), F.lit(0).cast("long"))
    return g.agg(n(F.col("a").isNotNull() & F.col("b").isNotNull()).alias("common"), n(F.col("b").isNull()).alias("only_left"), n(F.col("a").isNull()).alias("only_right"), n((F.col("a") > 1) | (F.col("b") > 1)).alias("repeated"))


def spread(df: DataFrame, value: str) -> DataFrame:
    """Count, mean, deviation, extremes and exact percentiles."""
    c = F.col(value)
    df = staged(df.select(value), "values")  # counted, then ranked
    plain = df.agg(F.count(c).alias("n"), F.avg(c).alias("mean"), F.stddev(c).alias("deviation"), F.min(c).alias("least"), F.max(c).alias("greatest"))
    return plain.join(percentiles(df, value, [10, 25, 50, 75, 90, 99]), F.lit(True))  # one row each
