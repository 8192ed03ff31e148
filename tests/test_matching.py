import random

import numpy as np
import pytest

from samefold.operators import blocking, evaluation, features, matching
from samefold.sources import staging, tables
from samefold.streaming.incremental import match_stream

REC = "entity_id string, name string, address string, country string"


@pytest.fixture(scope="module")
def sides(spark):
    s1 = spark.createDataFrame([("S1-1", "acme tools", "12 main road", "us"), ("S1-2", "beta", "", "us"), ("S1-3", "", "", "us"), ("S1-4", "acme tools", "x", "")], REC)
    src = spark.createDataFrame([("S2-1", "acme tools", "12 main road", "us"), ("S2-2", "acme trade", "main street", "us"), ("S3-1", "beta", "9 high road", "us"), ("S3-2", "acme tools", "12 main road", "india")], REC)
    return s1, src


def test_candidates_rank_and_cap(spark, sides):
    got = blocking.candidates(*sides, k=5).orderBy("sid", "block_rank").collect()
    assert [(r.sid, r.cid, r.block_rank) for r in got] == [("S1-1", "S2-1", 1), ("S1-1", "S2-2", 2), ("S1-1", "S3-1", 3), ("S1-2", "S3-1", 1)]
    capped = blocking.hits(*sides, ["token1"], {"token1": 1}).collect()
    assert {r.sid for r in capped} == {"S1-2"}
    assert {r.sid for r in blocking.without_candidates(sides[0], blocking.candidates(*sides)).collect()} == {"S1-3", "S1-4"}


def test_features_and_decisions(spark, sides):
    pairs = features.with_records(blocking.candidates(*sides), *sides)
    f = {(r.sid, r.cid): r for r in features.fuzzy(pairs, 1).collect()}
    assert set(f) == {("S1-1", "S2-1"), ("S1-2", "S3-1")}
    assert f["S1-1", "S2-1"].name_ratio == 100.0 and f["S1-1", "S2-1"].address_number_match == 1
    p = features.proxy(pairs).withColumnRenamed("name_ratio", "x").withColumn("probability", blocking.F.col("x") / 100)
    kept = matching.by_margin(p, 0.5)
    assert {(r.sid, r.cid) for r in kept.collect()} == {("S1-1", "S2-1"), ("S1-2", "S3-1")}
    out = {r.sid: r.matched_entity_ids for r in matching.assemble(sides[0], kept).collect()}
    assert out == {"S1-1": "S2-1", "S1-2": "S3-1", "S1-3": "", "S1-4": ""}


def test_feature_order_guard(spark, sides):
    with pytest.raises(ValueError):
        matching.train(spark.createDataFrame([(1,)], "label int"))


def test_empty_answers(spark, sides):
    truth = spark.createDataFrame([("S1-1", "S2-1")], "sid string, cid string")
    none = truth.limit(0)
    assert evaluation.macro_f05(sides[0], truth, truth).first().macro_f05 == 0.25
    assert evaluation.macro_f05(sides[0], truth, truth, 1.0).first().macro_f05 == 1.0
    assert evaluation.pair_metrics(truth, none).first().precision == 0.0
    assert evaluation.best_possible_f05(1.0) == 1.0


def test_delimited_round_trip(spark, sides, tmp_path):
    path = str(tmp_path / "r")
    df = sides[0].toDF("ID", "Name", "Address", "Country_Code")
    tables.write_delimited(df, path)
    got = tables.read_records(spark, path).orderBy("entity_id").collect()
    assert [r.business_name for r in got] == ["acme tools", "beta", "", "acme tools"]
    truth = spark.createDataFrame([("S1-1", "S2-1, S2-2|S3-1"), ("S1-2", "")], tables.TRUTH)
    assert tables.truth_pairs(truth).count() == 3 and tables.truth_pairs(truth, "S2-").count() == 2
    with pytest.raises(FileNotFoundError):
        tables.require_paths(spark, path + "-none")
    with pytest.raises(ValueError):
        tables.require_rows(df, 9)


def test_stream_matches_each_arrival_once(spark, sides, tmp_path):
    inp, out, cp = (str(tmp_path / x) for x in ("in", "out", "cp"))
    for i in (1, 2):
        sides[0].where(f"entity_id = 'S1-{i}'").write.mode("append").parquet(inp)
        match_stream(spark, inp, sides[0].schema, sides[1], out, cp).awaitTermination(120)
    got = spark.read.parquet(out)
    assert got.count() == 4 and got.select("batch").distinct().count() == 2


def test_cap_of_50_drops_larger_blocks(spark):
    s1 = spark.createDataFrame([("S1-1", "acme", "", "us"), ("S1-2", "beta", "", "us")], REC)
    src = spark.createDataFrame([(f"S2-{n}-{i}", n, "", "us") for n, k in (("acme", 51), ("beta", 50)) for i in range(k)], REC)
    rule = ["exact_name"]
    assert {(r.sid, r["count"]) for r in blocking.hits(s1, src, rule).groupBy("sid").count().collect()} == {("S1-1", 51), ("S1-2", 50)}
    assert {(r.sid, r["count"]) for r in blocking.hits(s1, src, rule, {"exact_name": 50}).groupBy("sid").count().collect()} == {("S1-2", 50)}
    assert [(r.key, r.n) for r in blocking.oversized(blocking.keys(src, rule), {"exact_name": 50}).collect()] == [("acme", 51)]


def test_expression_features_keep_repeats_and_empty_tokens(spark):
    """By the definitions: token lists with repeats in the denominators, an empty text is one empty token."""
    rows = [("a", "b", "acme acme", "1 main main road", "us", "acme acme corp", "main road", "us", 1), ("a", "c", "", "", "us", "", "", "us", 2), ("a", "d", "", "x", "us", "acme", "", "in", 3)]
    pairs = spark.createDataFrame(rows, "sid string, cid string, n1 string, a1 string, c1 string, n2 string, a2 string, c2 string, block_rank int")
    f = {r.cid: r for r in features.proxy(pairs).collect()}
    b = f["b"]
    assert (b.name_token_set_ratio, b.name_token_sort_ratio, b.shared_token_count, b.shared_token_ratio) == (50.0, 50.0, 1, 0.5)
    assert (b.address_partial_ratio, b.address_token_set_ratio) == (100.0, 100.0)
    c = f["c"]
    assert (c.name_token_set_ratio, c.name_token_sort_ratio, c.name_ratio, c.name_partial_ratio, c.address_partial_ratio, c.shared_token_count, c.name_exact) == (100.0, 100.0, 0.0, 80.0, 100.0, 1, 0)
    d = f["d"]
    assert (d.name_partial_ratio, d.name_token_set_ratio, d.address_token_set_ratio, d.shared_token_ratio, d.country_match) == (80.0, 0.0, 0.0, 0.0, 0)


def plain_lcs(a, b):
    last = [0] * (len(b) + 1)
    for x in a:
        now = [0]
        for j, y in enumerate(b):
            now.append(last[j] + 1 if x == y else max(last[j + 1], now[j]))
        last = now
    return last[-1]


def test_fuzzy_features_equal_brute_force(spark):
    rnd = random.Random(5)
    text = lambda: " ".join(rnd.choice(["acme", "acne", "tools", "tool", "main", "road", "12", "3"]) for _ in range(rnd.randint(0, 5)))
    rows = [("s", f"c{i:03}", text(), text(), "us", text(), text(), "us", i) for i in range(200)]
    pairs = spark.createDataFrame(rows, "sid string, cid string, n1 string, a1 string, c1 string, n2 string, a2 string, c2 string, block_rank int")
    ratio = lambda a, b: 200.0 * plain_lcs(a, b) / (len(a) + len(b)) if a + b else 100.0

    def partial(a, b):
        s, t = sorted((a, b), key=len)
        return max(ratio(s, t[max(0, i) : i + len(s)]) for i in range(1 - len(s), len(t))) if s else 0.0 if t else 100.0

    got = {r.cid: r for r in features.fuzzy(pairs, 300).collect()}
    for _, cid, n1, a1, _, n2, a2, _, _ in rows:
        g = got[cid]
        want = (ratio(n1, n2), partial(n1, n2), ratio(" ".join(sorted(n1.split())), " ".join(sorted(n2.split()))), ratio(a1, a2), partial(a1, a2))
        assert (g.name_ratio, g.name_partial_ratio, g.name_token_sort_ratio, g.address_ratio, g.address_partial_ratio) == pytest.approx(want)
        both = len(set(n1.split()) & set(n2.split()))
        assert g.shared_token_count == both and g.shared_token_ratio == pytest.approx(both / len(set(n1.split())) if n1 else 0.0)
        assert g.candidate_score == pytest.approx(0.45 * g.name_token_set_ratio + 0.2 * g.name_ratio + 0.15 * g.name_partial_ratio + 0.1 * g.address_token_set_ratio + 0.05 * g.address_ratio + 5 + 3 * g.address_number_match)
    best = sorted(rows, key=lambda r: (-got[r[1]].candidate_score, r[1]))[:7]
    assert {r.cid for r in features.fuzzy(pairs, 7).collect()} == {r[1] for r in best}


def test_model_is_saved_checked_and_reported(spark, tmp_path):
    rnd = random.Random(1)
    rows = [(f"S1-{i}", f"S2-{i}", i % 2, *[float(rnd.random() + (i % 2) * (k == 0)) for k in range(len(features.FEATURES))]) for i in range(200)]
    pairs = spark.createDataFrame(rows, "sid string, cid string, label int, " + ", ".join(f"{c} double" for c in features.FEATURES))
    model = matching.train(pairs, trees=3, depth=2)
    matching.save(model, str(tmp_path / "m"))
    again = matching.load(str(tmp_path / "m"))
    first, second = (matching.predict(m, pairs).orderBy("sid").collect() for m in (model, again))
    assert [r.probability for r in first] == [r.probability for r in second]
    assert matching.importance(again)[0][0] == features.FEATURES[0] and len(matching.importance(again)) == len(features.FEATURES)
    p = {r.sid: (r.label, round(r.probability, 6)) for r in first}
    pos, neg = ([x for y, x in p.values() if y == k] for k in (1, 0))
    auc = sum((a > b) + (a == b) / 2 for a in pos for b in neg) / (len(pos) * len(neg))
    scored = matching.predict(model, pairs)
    assert matching.score_areas(scored).first().roc_auc == pytest.approx(auc)
    assert matching.areas(scored)["areaUnderROC"] == pytest.approx(auc, abs=0.02)
    weights = {r.label: r.weight for r in matching.class_weight(pairs.where("label = 0 OR sid < 'S1-5'")).collect()}
    ones = pairs.where("label = 1 AND sid < 'S1-5'").count()
    assert weights == {0: 1.0, 1: pytest.approx(100 / ones)}
    with pytest.raises(ValueError):
        matching.require_candidates(pairs, pairs.limit(0))


def test_lists_lookups_and_staging(spark, tmp_path):
    lists = spark.createDataFrame([("S1-1", "S2-10, S2-11;S3-118|S3-8 "), ("S1-2", "")], "sid string, ids string")
    assert [tuple(r) for r in tables.parsed_list(lists, "ids").collect()] == [("S1-1", c, i + 1) for i, c in enumerate(["S2-10", "S2-11", "S3-118", "S3-8"])]
    pairs = spark.createDataFrame([("S1-1", "S2-1", 2, 7), ("S1-1", "S3-1", 1, 9), ("S1-2", "S2-1", 1, 5)], "source1_entity_id string, source_entity_id string, block_rank int, block_score int")
    tables.write_delimited(pairs, str(tmp_path / "pairs"), order=["source1_entity_id", "block_rank"])
    assert {tuple(r) for r in tables.read_candidates(spark, str(tmp_path / "pairs")).collect()} == {("S1-1", "S2-1", 2), ("S1-1", "S3-1", 1), ("S1-2", "S2-1", 1)}
    tables.write_delimited(lists.toDF("source1_entity_id", "candidate_entity_ids"), str(tmp_path / "lists"))
    assert tables.read_candidates(spark, str(tmp_path / "lists")).count() == 4
    for _ in range(2):
        tables.write_delimited(lists.where("sid = 'S1-1'"), str(tmp_path / "more"), mode="append")
    assert tables.read_delimited(spark, str(tmp_path / "more")).count() == 2
    assert [r.sid for r in tables.unfinished(lists, lists.where("sid = 'S1-1'"), "sid").collect()] == ["S1-2"]
    named = spark.createDataFrame([("S3-1", "n", "a", "us")], "source3_entity_id string, name string, address_full string, country_code string")
    assert tables.resolve(named).columns == list(tables.ALIASES)
    assert staging.registered(lists, "some_lists").count() == spark.sql("SELECT * FROM some_lists").count() == staging.staged(lists, "lists").count()
    with pytest.raises(ValueError):
        staging.require_unique(pairs, "source1_entity_id")
    got = {tuple(r) for r in evaluation.column_diff(lists, ["ids", "other"]).collect()}
    assert got == {("other", "missing", False), ("sid", "unexpected", False), ("ids", "present", False)}
    assert tuple(evaluation.alignment(lists.withColumnRenamed("sid", "entity_id"), pairs.withColumnRenamed("source1_entity_id", "sid")).first()) == (2, 0, 0, 1)


def test_block_joins_on_all_their_tokens(spark):
    rnd = random.Random(9)
    name = lambda: " ".join(rnd.choice(["acme", "acme", "tool", "road", "x", "corp"]) for _ in range(rnd.randint(0, 5)))
    rec = lambda p, n: [(f"{p}-{i}", name(), rnd.choice(["", "1 a", "2 b"]), rnd.choice(["us", "in"])) for i in range(n)]
    s1, src = rec("S1", 60), rec("S2", 90)
    a, b = spark.createDataFrame(s1, REC), spark.createDataFrame(src, REC)
    tok = lambda t: [w for w in t.split() if len(w) > 1]
    want = {(x[0], y[0]) for x in s1 for y in src if x[3] == y[3] and len(tok(x[1])) >= 2 and set(tok(x[1])[:2]) <= set(tok(y[1]))}
    assert {tuple(r) for r in blocking.tokens_any(a, b).collect()} == want
    pre = lambda t: t.replace(" ", "")[:3] if len(t.replace(" ", "")) >= 3 else ""
    want = set()
    for x in s1:
        for y in src:
            t, u = set(tok(x[1])), set(tok(y[1]))
            if x[3] == y[3] and pre(x[1]) and pre(x[1]) == pre(y[1]):
                half, number = bool(t and u) and len(t & u) >= 0.5 * min(len(t), len(u)), x[2] != "" and x[2] == y[2] and bool(t & u)
                if half or number:
                    want.add((x[0], y[0], half, number))
    assert {tuple(r) for r in blocking.prefix_residuals(a, b).collect()} == want


def test_percentiles_equal_numpy(spark):
    rng = np.random.default_rng(1)
    values = [(k, float(v)) for k, n in (("a", 1), ("b", 2), ("c", 500)) for v in rng.integers(0, 40, n) / 8] + [("c", None), ("d", None), (None, 3.0)]
    df = spark.createDataFrame(values, "k string, v double")
    got = {r.k: (r.p10, r.p25, r.p50, r.p99) for r in evaluation.percentiles(df, "v", [10, 25, 50, 99], ("k",)).collect()}
    want = {k: tuple(np.percentile([v for x, v in values if x == k and v is not None], [10, 25, 50, 99])) for k in ("a", "b", "c", None)}
    assert set(got) == set(want)
    for k in want:
        assert got[k] == pytest.approx(want[k])
    whole = evaluation.percentiles(df, "v", [10, 90]).collect()
    assert [tuple(r) for r in whole] == [pytest.approx(tuple(np.percentile([v for _, v in values if v is not None], [10, 90])))]
    assert [tuple(r) for r in evaluation.percentiles(df.where("false"), "v", [50]).collect()] == [(None,)]


def test_export_keeps_quotes_separators_and_blanks(spark, tmp_path):
    rows = [("1", ' a "b"\tc, '), ("2", '"'), ("3", "back\\slash"), ("4", "")]
    for sep in ("\t", ","):
        path = str(tmp_path / f"x{ord(sep)}")
        tables.write_delimited(spark.createDataFrame(rows, "id string, v string"), path, sep)
        assert sorted(tuple(r) for r in tables.read_delimited(spark, path, sep=sep).collect()) == rows


def test_cached_table_is_built_once_and_again_if_its_rows_differ(spark, tmp_path):
    built = []

    def build(n):
        return lambda: built.append(n) or spark.range(n)

    path = str(tmp_path / "cached")
    assert [staging.cached(spark, path, n, build(n)).count() for n in (3, 3, 5)] == [3, 3, 5]
    assert built == [3, 5]


def test_pairs_meet_in_tiles_without_shuffled_pairs(spark, monkeypatch):
    """Tiles, repeated ids, odd countries and ties against every pair counted plainly; the plan deals records, not pairs."""
    from samefold.operators import tiles

    rows = [(f"S{i % 3 + 1}-{i % 55}", f"{'ab'[i % 2]}name tok{i % 7} tok{i % 5} end", f"{i % 4} long street {i % 9}", [None, "", "x", "y"][i % 4] if i > 50 else "x") for i in range(60)]
    df = spark.createDataFrame(rows, "entity_id string, name string, address string, country string")
    s1, source = df.where("entity_id LIKE 'S1-%'"), df.where("entity_id NOT LIKE 'S1-%'")
    caps = {r: 12 for r in blocking.V8}
    right = blocking.keys(source)
    live = right.join(blocking.oversized(right, caps).drop("n"), ["rule", "key", "country"], "left_anti")
    plain = blocking.keys(s1).withColumnRenamed("entity_id", "sid").join(live.withColumnRenamed("entity_id", "cid"), ["rule", "key", "country"]).groupBy("sid", "cid", "rule").count().collect()
    want = {(r.sid, r.cid, r.rule, r["count"]) for r in plain if r["count"] >= blocking.RULES[r.rule].least}
    found = spark.createDataFrame(list(want), "sid string, cid string, rule string, n long")
    best = {tuple(r) for r in blocking.top_k(blocking.scored(found), 3).collect()}
    assert want and len(best) > 20
    for most in (100_000, 4):
        monkeypatch.setattr(tiles, "S1_ROWS", most)
        monkeypatch.setattr(tiles, "SOURCE_ROWS", most)
        assert {tuple(r) for r in blocking.hits(s1, source, caps=caps).collect()} == want
        assert {tuple(r) for r in blocking.hits_of(found, s1, source, caps=caps).collect()} == want
        for scheme in ("sum", "max", "votes"):
            assert {tuple(r) for r in blocking.scored_pairs(s1, source, scheme=scheme, caps=caps).collect()} == {tuple(r) for r in blocking.scored(found, scheme).collect()}
        got = blocking.candidates(s1, source, k=3, caps=caps)
        assert {tuple(r) for r in got.select("sid", "cid", "block_score", "block_rules", "block_rank").collect()} == best
    plan = blocking.hits(s1, source)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(cell" in plan and "hashpartitioning(sid" not in plan
