"""Brute-force twins, repeated ids, ties, clashing names and size switches."""

import math
import os
import random
import re
import zlib
from collections import Counter
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from samefold.llm import bagminhash, common, embed_dedup, fingerprint, packing, quality, queries, secrets, shingles, substring, tokens, toxicity

SF = "/root/testdata/sf0.001"
TEXTS = "doc_id long, text string"


def test_word_hashes_equal_split():
    rnd = random.Random(0)
    texts = ["".join(rnd.choice("abXÉ中ß \t\n 　 \u0085 ​\x1c") for _ in range(rnd.randint(0, 40))) for _ in range(2000)] + ["", None, "x" * 5000 + " yy " + "x" * 5000, "a " * 300]
    h, b = shingles.word_hashes(pa.array(texts))
    known = {}
    for i, t in enumerate(texts):
        words, got = (t or "").lower().split(), h[b[i] : b[i + 1]].tolist()
        assert len(words) == len(got) and all(known.setdefault(w, x) == x for w, x in zip(words, got))
    assert len(known) == len(set(known.values()))


@pytest.fixture
def no_broadcast(monkeypatch):
    monkeypatch.setattr(common, "few", lambda df, rows=0: False)


def repeated(spark):
    rnd = random.Random(7)
    a, b = (" ".join(f"{p}{rnd.randrange(10**6)}" for _ in range(80)) for p in "ab")
    rows = [(1, b), (1, a), (2, a), (3, b), (3, b), (4, None), (4, ""), (None, a)]
    return spark.createDataFrame(rows, TEXTS), a, b


def groups_of(docs):
    return sorted(tuple(r) for r in bagminhash.near_duplicates(docs).collect()), sorted(tuple(r) for r in substring.repeated_passages(docs).collect()), sorted((r.doc_id or 0, r.text or "") for r in bagminhash.drop_near_duplicates(docs).collect())


def test_repeated_ids_have_one_text_at_every_size(spark, monkeypatch):
    docs, a, b = repeated(spark)
    small = groups_of(docs)
    assert small[0] == [(1, 1, True), (2, 1, False), (3, 3, True), (4, 4, True)]
    assert small[1] == [(2, 0, 80, 1)]
    assert small[2] == [(0, a), (1, a), (3, b), (4, "")]
    monkeypatch.setattr(common, "few", lambda df, rows=0: False)
    assert groups_of(docs) == small


def test_near_duplicates_without_broadcast(spark, no_broadcast):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    from test_llm import brute_groups

    assert {r.doc_id: r.group_id for r in bagminhash.near_duplicates(docs).collect()} == brute_groups(docs.collect())


def test_family_below_the_bound_stages_few_pairs(spark, monkeypatch):
    rnd = np.random.default_rng(3)
    base = [f"t{x}" for x in rnd.integers(0, 10**9, 1000)]
    rows = []
    for i in range(240):
        w = list(base)
        for k in rnd.choice(200, 13, replace=False):
            w[5 * k] = f"e{i}x{k}"
        rows.append((i, " ".join(w)))
    staged, count = common.staged, Counter()

    def spy(df, name):
        out = staged(df, name)
        count[name] += out.count() if name in ("cross", "pairs", "links", "tried", "dense") else 0
        return out

    monkeypatch.setattr(common, "staged", spy)
    got = {r.doc_id: r.group_id for r in bagminhash.near_duplicates(spark.createDataFrame(rows, TEXTS)).collect()}
    from test_llm import brute_groups

    want = brute_groups([SimpleNamespace(doc_id=i, text=t) for i, t in rows])
    # a pair on the bound shares no band once in 20,000 times, so a group may fall apart, but none may grow
    assert all(len({want[j] for j in got if got[j] == g}) == 1 for g in set(got.values())) and sum(got[i] == want[i] for i in got) >= 0.95 * 240
    buckets = 240 * bagminhash.BANDS
    assert count["dense"] and count["cross"] <= bagminhash.FEW * buckets and count["links"] < 4 * 240 and count["pairs"] < 240 * 239 / 8


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_passage_behind_common_phrases(spark, seed):
    rnd = np.random.default_rng(seed)
    words = lambda n: [f"w{x}" for x in rnd.integers(0, 10**9, n)]
    passage = words(60)
    rows = [(i, words(100) + passage[i % 56 : i % 56 + 5] + words(60)) for i in range(448)]
    rows += [(1000, words(20) + passage + words(40)), (1001, words(30) + passage + words(40))]
    got = substring.repeated_passages(spark.createDataFrame([(i, " ".join(w)) for i, w in rows], TEXTS)).collect()
    assert [tuple(r) for r in got] == [(1001, 30, 90, 1000)]


def test_passages_brute_force(spark):
    """Every run of 50 words that an earlier document holds is reported; every report is similar enough."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    line = " ".join(f"r{i}" for i in range(55))
    more = [(10**6, " ".join([line] * 4)), (10**6 + 1, f"{line} x {line} {line}"), (10**6 + 2, f"y {line} x {line} z")]
    docs = docs.unionByName(spark.createDataFrame(more, TEXTS))
    texts = {r.doc_id: (r.text or "").lower().split() for r in docs.collect()}
    spans = {}
    for r in substring.repeated_passages(docs).collect():
        spans.setdefault(r.doc_id, []).append((r.start_word, r.end_word))
        mine = [tuple(texts[r.doc_id][i : i + 5]) for i in range(r.start_word, r.end_word - 4)]
        theirs = {tuple(texts[r.earlier_id][i : i + 5]) for i in range(len(texts[r.earlier_id]) - 4)}
        assert r.earlier_id < r.doc_id and r.end_word - r.start_word >= 50 and sum(m in theirs for m in mine) >= 0.8 * len(mine)
    seen, repeats = set(), 0
    for i in sorted(texts):
        runs = {tuple(texts[i][k : k + 50]): k for k in range(len(texts[i]) - 49)}
        for run, _ in runs.items():
            if run in seen:
                repeats += 1
                assert any(texts[i][k : k + 50] == list(run) and any(a <= k and k + 50 <= z for a, z in spans.get(i, [])) for k in [runs[run]])
        seen.update(runs)
    assert repeats > 1000


def test_every_pair_of_near_passages_is_reported(spark):
    """A family of near copies and phrases of it: each pair over the threshold, not only that with the first document."""
    rnd = np.random.default_rng(5)
    words = lambda n: [f"w{x}" for x in rnd.integers(0, 10**9, n)]
    base, rows = words(150), []
    for i in range(40):
        edited = list(base)
        for k in rnd.choice(150, 1 + i % 4, replace=False):
            edited[k] = words(1)[0]
        rows.append((i, words(30) + edited + words(40)))
    rows += [(100 + i, words(60) + base[3 * i : 3 * i + 12] + words(50)) for i in range(20)]
    want = set()
    for b, y in rows:
        there = {tuple(y[k : k + 5]) for k in range(len(y) - 4)}
        for a, x in rows:
            hit = np.asarray([tuple(x[k : k + 5]) in there for k in range(len(x) - 4)])
            if a > b and substring.passages(hit, 46, 0.8):
                want.add((a, b))
    got = {(r.doc_id, r.earlier_id) for r in substring.repeated_passages(spark.createDataFrame([(i, " ".join(w)) for i, w in rows], TEXTS)).collect()}
    assert len(want) > 600 and len(got & want) >= 0.99 * len(want) and got <= want


def test_every_pair_of_a_crowded_passage_is_reported(spark):
    """More near copies of a passage than are paired whole, behind one that holds half of it and 130 exact copies of that half."""
    rnd = np.random.default_rng(7)
    words = lambda n: [f"w{x}" for x in rnd.integers(0, 10**9, n)]
    base = words(110)
    rows = [(i, words(20) + base[:55] + words(30)) for i in range(130)]
    for i in range(130):
        edited = list(base)
        for k in [5 + i % 45, 58 + (7 * i) % 50, 58 + (11 * i + 3) % 50]:
            edited[k] = words(1)[0]
        rows.append((1000 + i, words(30) + edited + words(20)))
    want = set()
    for b, y in rows[130:]:
        there = {tuple(y[k : k + 5]) for k in range(len(y) - 4)}
        for a, x in rows[130:]:
            hit = np.asarray([tuple(x[k : k + 5]) in there for k in range(len(x) - 4)])
            if a > b and substring.passages(hit, 46, 0.8):
                want.add((a, b))
    got = {(r.doc_id, r.earlier_id) for r in substring.repeated_passages(spark.createDataFrame([(i, " ".join(w)) for i, w in rows], TEXTS)).collect()}
    assert {(i, 0) for i in range(1, 130)} <= got and len(want) > 3000
    assert len(got & want) >= 0.99 * len(want), (len(got & want), len(want))


def test_a_crowd_sends_its_texts_once_a_square_of_pairs(spark, monkeypatch):
    """Texts of a crowd are not sent once a pair, however its pairs are dealt; windows go before pairs are made."""
    rnd = np.random.default_rng(8)
    words = lambda n: [f"w{x}" for x in rnd.integers(0, 10**9, n)]
    base, rows = words(110), []
    for i in range(130):
        edited = list(base)
        for k in [5 + i % 45, 58 + (7 * i) % 50, 58 + (11 * i + 3) % 50]:
            edited[k] = words(1)[0]
        rows.append((i, words(30) + edited + words(20)))
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in rows], TEXTS)
    staged, tables, counts, left = common.staged, {}, [], []

    def spy(df, name):
        out = tables[name] = staged(df, name)
        if name == "needed":
            counts.append(out.count())
        if name == "pairs":
            left.append(os.path.exists(tables["windows"]._samefold_path.removeprefix("file:")))
        return out

    monkeypatch.setattr(common, "staged", spy)
    got = []
    for size in (20_000, 200):  # one square, and many
        monkeypatch.setattr(substring, "CELL_PAIRS", size)
        got.append(sorted(tuple(r) for r in substring.repeated_passages(docs).collect()))
    assert got[0] == got[1] and len(got[0]) > 3000
    assert counts[0] <= 3 * 130 and counts[2] < len(got[0]) / 2, counts
    assert left == [False, False]


def test_a_crowd_takes_rows_of_its_documents_and_keeps_all_links(spark, monkeypatch):
    """No table of op2 holds a row a pair, and its result names every document of ``repeated_passages``."""
    rnd = np.random.default_rng(9)
    words = lambda n: [f"w{x}" for x in rnd.integers(0, 10**9, n)]
    base, rows = words(110), []
    for i in range(130):
        edited = list(base)
        for k in [5 + i % 45, 58 + (7 * i) % 50, 58 + (11 * i + 3) % 50]:
            edited[k] = words(1)[0]
        rows.append((i, words(30) + edited + words(20)))
    rows += [(200, rows[7][1])]
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in rows], TEXTS)
    monkeypatch.setattr(substring, "CELL_PAIRS", 2000)  # several squares, whose passages overlap
    want = {}
    for r in sorted(tuple(r) for r in substring.repeated_passages(docs).collect()):
        held = want.setdefault(r[0], [])
        if held and r[1] < held[-1][1]:
            held[-1][1], held[-1][2] = max(held[-1][1], r[2]), held[-1][2] | {r[3]}
        else:
            held.append([r[1], r[2], {r[3]}])
    staged, counts = common.staged, {}

    def spy(df, name):
        out = staged(df, name)
        counts[name] = max(counts.get(name, 0), out.count())
        return out

    monkeypatch.setattr(common, "staged", spy)
    monkeypatch.setattr(queries, "documents", lambda spark, sf: docs)
    got = queries.op2_substring_dedup(spark, "").collect()
    assert sorted((r.doc_id, r.start_word, r.end_word, r.links) for r in got) == sorted((d, a, z, sorted(b)) for d, x in want.items() for a, z, b in x)
    assert all(r.earlier_id == r.links[0] and r.n_links == len(r.links) for r in got) and sum(r.n_links for r in got) > 3000
    assert counts["pairs"] <= 130 and counts["dealt"] <= 3 * 130 and counts["found"] <= 9 * 130, counts


@pytest.mark.parametrize("seed", range(3))
def test_slots_tell_what_they_hold(seed):
    rnd = np.random.default_rng(seed)
    known = np.concatenate([rnd.integers(0, 1 << 64, 3000 * seed, np.uint64), np.arange(2 * seed, dtype=np.uint64) << np.uint64(20)])
    x = np.concatenate([known, rnd.integers(0, 1 << 64, 5000, np.uint64), ~np.arange(300, dtype=np.uint64), np.arange(300, dtype=np.uint64)])
    assert (substring.among(x, substring.slots(known)) == np.isin(x, known)).all()


@pytest.mark.parametrize("seed", range(4))
def test_representatives_hold_what_is_left_out(seed):
    rnd = np.random.default_rng(seed)
    base = rnd.integers(0, 40, (4, 30))
    texts = [np.concatenate([base[rnd.integers(4)][: rnd.integers(5, 30)], rnd.integers(0, 60 if i % 3 else 10**6, rnd.integers(0, 9))]) for i in range(120)]
    owner, token = np.repeat(np.arange(120), [len(t) for t in texts]), np.concatenate(texts)
    need = 12
    got = set(zip(*(x.tolist() for x in substring.representatives(owner, token, need))))
    sets = [set(t.tolist()) for t in texts]
    enough = lambda a, b: sum(x in sets[b] for x in texts[a].tolist()) >= need
    assert all(b < a and enough(a, b) for a, b in got)
    left = 0
    for a in range(120):
        for b in range(a):
            if enough(a, b) and (a, b) not in got:
                left += 1
                both = sets[a] & sets[b]
                assert any((a, z) in got and both <= sets[z] for z in range(a)) or any(both <= sets[z] and ((b, z) in got) and ((a, z) in got) for z in range(b))
    assert left


def test_no_text_is_shuffled_to_find_its_bucket(spark, monkeypatch):
    rows = [(i, f"text {i // 3}") for i in range(300)] + [(i, f"single {i}") for i in range(300, 400)] + [(None, "text 5"), (None, None)]
    staged, plans = common.staged, {}

    def spy(df, name):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return staged(df, name)

    monkeypatch.setattr(common, "staged", spy)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for size in (10**6, 40):  # one slice of wanted ids, and eight
            monkeypatch.setattr(common, "BROADCAST_ROWS", size)
            got = {(r.doc_id, r.fingerprint): (r.first_id, r.n_equal) for r in fingerprint.exact_groups(spark.createDataFrame(rows, TEXTS)).collect()}
            assert "BroadcastHashJoin" in plans["texts"] and "Exchange hashpartitioning" not in plans["texts"] and "SortMergeJoin" not in plans["texts"]
            members = {}
            for i, t in rows:
                members.setdefault(fingerprint.canonical(t), []).append(i)
            assert got == {(i, fingerprint.digest(c)): (min((x for x in m if x is not None), default=None), len(m)) for c, m in members.items() for i in m}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_groups_are_paired_in_slices(monkeypatch):
    rnd = np.random.default_rng(6)
    links = [(k, 1 + int(rnd.integers(1, n)), 0, *rnd.integers(0, 9, 4).tolist()) for k, n in enumerate((3, 9, 40)) for _ in range(3 * n)]
    cols = [np.asarray(c) for c in zip(*links)]
    members = {k: {(r[1], r[3], r[4]) for r in links if r[0] == k} | {(r[2], r[5], r[6]) for r in links if r[0] == k} for k in range(3)}
    for size in (7, 10**6):
        monkeypatch.setattr(substring, "PAIR_ROWS", size)
        got = [r for part in substring.paired(*cols, 20) for r in zip(*(c.tolist() for c in part))]
        assert sorted(r for r in got if r[0] == 2) == sorted(r for r in links if r[0] == 2)
        for k in (0, 1):
            mine = [r for r in got if r[0] == k]
            assert len(set(mine)) == len(mine) and {(r[1], r[2]) for r in mine} == {(a, b) for a, *_ in members[k] for b, *_ in members[k] if a > b}
            assert {x for r in mine for x in ((r[1], r[3], r[4]), (r[2], r[5], r[6]))} == members[k]


def brute_links(x, ids, bound=0.95):
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    link = (u @ u.T >= bound) & ~np.eye(len(x), dtype=bool)
    root = np.arange(len(x))
    while True:
        new = np.where(link, root[None, :], len(x)).min(axis=1)
        new = np.minimum(new, root)
        if (new == root).all():
            break
        root = new
    return link.sum(axis=1), {i: min(ids[j] for j in range(len(x)) if root[j] == root[k]) for k, i in enumerate(ids)}


def test_embeddings_components_and_counts(spark, monkeypatch):
    rnd = np.random.default_rng(4)
    centres = rnd.standard_normal((40, 32))
    x = np.concatenate([centres[rnd.integers(0, 40, 900)] + rnd.standard_normal((900, 32)) * rnd.choice([0.05, 0.2, 0.24], (900, 1)), rnd.standard_normal((300, 32))]).astype(np.float32).astype(float)
    ids = [int(i) for i in rnd.permutation(len(x))]
    df = spark.createDataFrame([(i, v.tolist(), 1, "x", 2) for i, v in zip(ids, x)], "vec_id long, embedding array<float>, cell int, tab string, links int")
    degree, component = brute_links(x, ids)
    monkeypatch.setattr(embed_dedup, "QUERIES", 16)
    monkeypatch.setattr(embed_dedup, "SLICE", 16)
    for _ in range(2):  # crowded cells in grids, then whole
        got = {r.vec_id: r for r in embed_dedup.dedup(df).collect()}
        found = sum(got[i].n_links for i in ids)
        assert len(got) == len(ids) and all(got[i].n_links <= d for i, d in zip(ids, degree)) and found >= 0.99 * degree.sum() > 0
        assert np.mean([got[i].component_id == component[i] for i in ids]) >= 0.99 and all(got[i].kept == (got[i].component_id == i) for i in ids)
        monkeypatch.undo()


def test_embeddings_repeated_ids_and_odd_rows(spark):
    a, b = [1.0, 0.0, 0.5], [0.0, 1.0, 0.0]
    rows = [(1, a), (1, a), (2, a), (3, b), (3, None), (4, [2.0, 0.0, 1.0]), (5, []), (6, None), (7, [0.0] * 3), (8, [1.0, None, 1.0]), (9, [1.0, float("inf"), 0.0]), (10, [1.0]), (None, a)]
    got = {r.vec_id: tuple(r)[1:] for r in embed_dedup.dedup(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    assert got == {1: (2, 1, True), 2: (2, 1, False), 4: (2, 1, False), **{i: (0, i, True) for i in (3, 5, 6, 7, 8, 9, 10)}}


def test_tables_grow_slowly():
    assert embed_dedup.tables(10**10, 64, 0.95)[1] <= 6 * embed_dedup.tables(10**4, 64, 0.95)[1]
    near, far = embed_dedup.agreement(64, 0.95)
    assert 0.55 < near < 0.65 and far < 0.01


def test_packing_equals_plain_tokenization(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = packing.best_fit_pack(docs).collect()
    tok = tokens.load().tok
    want, total = Counter(), 0
    for r in docs.collect():
        ids = [*tok.encode(r.text or "", add_special_tokens=False).ids, 1]
        total += len(ids)
        for p, k in enumerate(range(0, len(ids), 4096)):
            part = np.asarray(ids[k : k + 4096], "<u4")
            want[r.doc_id, p, k, len(part), zlib.crc32(part.tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    assert len({r.sequence_id for r in rows}) == math.ceil(total / 4096)


def test_packing_program_meets_its_bound():
    rnd = random.Random(2)
    hist = Counter(min(4096, 1 + int(rnd.lognormvariate(6.5, 1.2))) for _ in range(30000))
    runs, used = packing.plan(hist)
    placed = Counter()
    for length, _, count, _, _ in runs.tolist():
        placed[length] += count
    plain = sum(c for c, _ in packing._best_fit([], dict(hist), 4096))
    assert placed == hist and used <= plain and used <= math.ceil(sum(k * v for k, v in hist.items()) / 4096) + 1
    thirds = Counter({1366: 4000, 1365: 4000, 1300: 4000, 2800: 4000, 2796: 4000})
    assert packing.plan(thirds)[1] < sum(c for c, _ in packing._best_fit([], dict(thirds), 4096))
    units = np.asarray([10, 13, 20])
    demand = np.asarray([30.0, 7.0, 11.0])
    found = packing.configurations(units, demand, 40)
    cover = np.zeros(3)
    for fill, x in found.items():
        assert units[list(fill)].sum() <= 40
        np.add.at(cover, list(fill), x)
    assert (cover >= demand * 0.999).all()
    for n in (1, 2, 7, 2270):
        assert len({k * packing.scatter(n) % n for k in range(n)}) == n


def test_newer_rule_version_replaces_the_older(spark, tmp_path):
    docs = spark.createDataFrame([(1, "alpha beta"), (2, "x")], TEXTS)
    for version, word in ((1, "alpha"), (2, "beta")):
        rows = secrets.scan_history(docs, str(tmp_path / "l"), rules=(secrets.Rule("word", version, word),)).collect()
        assert [(s.start, s.stop, s.version) for r in rows for s in r.findings] == [((0, 5, 1), (6, 10, 2))[version - 1]]


def test_long_text_with_many_hits(spark):
    n = 6000
    text = " ".join(f"token=abcdefgh{i} zé" for i in range(n))
    docs = spark.createDataFrame([(1, text)], TEXTS)
    spans = [(m.start(), m.end()) for m in re.finditer(r"token=[a-z0-9]+", text)]
    r = secrets.secret_report(docs).first()
    assert r.n_assign == n and r.spans == ",".join(f"assign:{a}:{z}" for a, z in spans)
    assert secrets.redact(docs).first().text == re.sub(r"token=[a-z0-9]+", "[assign]", text)


def test_ranges_are_searched_in_two_steps(spark):
    rnd = random.Random(1)
    rows = [(rnd.randrange(-(10**12), 10**12), f"t{i}") for i in range(900)] + [(5, "a"), (5, "b"), (None, "c")]
    docs = spark.createDataFrame(rows, TEXTS)
    got = fingerprint.with_next(docs, rows_per_range=9).collect()
    keys = {}
    for r in got:
        if not r.ghost:
            keys.setdefault(r.range, []).append(r.key)
    order = sorted(keys)
    assert sum(map(len, keys.values())) == len(rows) and len(order) > 20
    assert all(max(keys[a]) < min(keys[b]) for a, b in zip(order, order[1:]))


def test_votes_equal_a_plain_loop():
    rnd = np.random.default_rng(1)
    z = quality.unit(rnd.standard_normal((50, 8)))
    lab = quality.unit(np.round(rnd.standard_normal((70, 8))))
    lab[40:45] = lab[3]  # ties
    y, weight = rnd.integers(0, 2, 70).astype(float), rnd.random(70) + 0.5
    got = quality.vote(z, lab, y, weight, 0.3, k=5)
    for i in range(len(z)):
        cos = [float(z[i] @ v) for v in lab]
        last = sorted(cos)[-5]
        votes = [(max(0.0, min(1.0, c)) ** quality.SHARPNESS * w, t) for c, w, t in zip(cos, weight, y) if c >= last - 1e-12]
        total = sum(w for w, _ in votes)
        assert got[i] == pytest.approx(sum(w * t for w, t in votes) / total if total else 0.3)
    x = rnd.standard_normal((40, 30)).astype(np.float32)
    mean, v = quality.fit(x, rank=5)
    u, s, vt = np.linalg.svd(x - x.mean(axis=0), full_matrices=False)
    assert np.abs(np.abs(((x - mean) @ v)) - np.abs((u * s)[:, :5])).max() < 0.05 * s[0]


def test_penalty_spares_neutral_mentions(spark):
    """One group is named in most toxic documents, the other hardly; neutral mentions of both are scored."""
    rnd = random.Random(3)
    filler = [f"w{i}" for i in range(60)]
    insults = ["scum", "idiot", "trash", "vermin"]
    say = lambda who, bad: " ".join([*rnd.sample(filler, 6), who, *([rnd.choice(insults)] if bad and rnd.random() < 0.75 else []), *rnd.sample(filler, 4)])
    rows = [(i, say("muslims" if rnd.random() < (0.85 if i % 2 else 0.1) else "christians", i % 2)) for i in range(800)]
    docs = spark.createDataFrame(rows, TEXTS)
    marks = spark.createDataFrame([(i, i % 2) for i, _ in rows], "doc_id long, toxic int")
    neutral = spark.createDataFrame([(i, say("muslims", False)) for i in range(300)], TEXTS)
    data, totals = toxicity.sample(docs, marks, "toxic")
    names = toxicity.select_features(data)
    wrong = {}
    for fairness in (0.0, 5.0):
        beta = toxicity.fit(data, totals, names, fairness=fairness)
        wrong[fairness] = toxicity.score(neutral, names, beta).where("score >= 0.5").count() / 300
    assert wrong[0.0] > 0.5 and wrong[5.0] < 0.5 * wrong[0.0]


def test_shared_folder_is_asked_for_off_the_local_master():
    stub = SimpleNamespace(conf=SimpleNamespace(get=lambda *_: None), sparkContext=SimpleNamespace(master="spark://h:7077", _jsc=SimpleNamespace(sc=lambda: SimpleNamespace(getCheckpointDir=lambda: SimpleNamespace(isDefined=lambda: False)))))
    with pytest.raises(ValueError):
        common.shared_dir(stub)


def test_partitions_grow_with_the_table(spark):
    assert common.parts(spark, 10, 100) == int(spark.conf.get("spark.sql.shuffle.partitions")) and common.parts(spark, 10**9, 10**5) == 10**4
    assert common.join_small(spark.range(5), spark.range(3), "id").count() == 3 and F


def test_pairs_are_checked_side_by_side_like_one_by_one(monkeypatch):
    """Windows of all functions at once, covered intervals and verified pairs against plain loops, in batches cut anywhere."""
    rng = np.random.default_rng(5)
    h = rng.integers(0, 1 << 63, 4000).astype(np.uint64)
    h[500:700] = h[100:300]
    bounds = np.asarray([0, 3, 900, 900, 4000])
    for got, seed in zip(substring.windows_of(h, bounds, 46, [1, 2, 3]), (1, 2, 3)):
        want = set()
        value = substring.shingles.mix(h ^ np.uint64(seed * 0x9E3779B97F4A7C15 & (1 << 64) - 1)) & ~np.uint64((1 << 20) - 1) | np.arange(4000, dtype=np.uint64)
        todo = [(a, z) for a, z in zip(bounds.tolist(), bounds[1:].tolist())]
        while todo:
            a, z = todo.pop()
            if z - a >= 46:
                c = a + int(value[a:z].argmin())
                want.add((a, c, z))
                todo += [(a, c), (c + 1, z)]
        assert set(zip(*(x.tolist() for x in got))) == want and want
    n = 400
    owner, f, l = np.sort(rng.integers(0, 30, n)), rng.integers(0, 6, n), rng.integers(0, 300, n)
    r = l + rng.integers(1, 120, n)
    want = []
    for o in range(30):
        cover = np.zeros(500, int)
        for k in range(6):
            on = np.zeros(500, bool)
            for a, z in zip(l[(owner == o) & (f == k)], r[(owner == o) & (f == k)]):
                on[a:z] = True
            cover += on
        edge = np.flatnonzero(np.diff(np.concatenate([[0], (cover >= 2).astype(int), [0]]))).reshape(-1, 2)
        want += [(o, a, z) for a, z in edge.tolist() if z - a >= 20]
    assert list(zip(*(x.tolist() for x in substring.overlapping(owner, f, l, r, 2, 20)))) == want
    least, rows, want = 10, [], set()
    for cell in range(6):
        texts = {d: rng.integers(0, 1 << 62, 300) for d in range(cell * 10, cell * 10 + 4)}
        for later in (2, 3):
            for earlier in (0, 1):
                at = int(rng.integers(20, 200))
                texts[cell * 10 + later][at : at + 60] = texts[cell * 10 + earlier][at - 15 : at + 45]
                texts[cell * 10 + later][at + 20 + 11 * later] = 7
        rows += [(cell, 0, 0, cell * 10 + d, None, [[0, 300]], None, texts[cell * 10 + d].tolist()) for d in (0, 1)]
        for later in (2, 3):
            doc = cell * 10 + later
            rows.append((cell, 0, 1, doc, None, [[0, 140], [150, 300]], None, np.delete(texts[doc], range(140, 150)).tolist()))
            for earlier in (cell * 10, cell * 10 + 1):
                mine, theirs = [[0, 140], [150, 300]], [[0, 200], [150, 290]]
                rows.append((cell, 0, 1, doc, earlier, mine, theirs, None))
                there = set(texts[earlier][:290].tolist())
                whole = {tuple(texts[earlier][i : i + least].tolist()) for i in range(291)}
                for p, q in mine:
                    hit = np.asarray([x in there for x in texts[doc][p:q].tolist()])
                    want |= {(doc, p + a, p + z + 4, earlier, 0) for a, z in substring.passages(hit, least, 0.8)}
                    same = np.asarray([tuple(texts[doc][i : i + least].tolist()) in whole for i in range(p, q - least + 1)])
                    edge = np.flatnonzero(np.diff(np.concatenate([[0], same.astype(int), [0]]))).reshape(-1, 2)
                    want |= {(doc, p + a, p + z + least + 3, earlier, 1) for a, z in edge.tolist()}
    kind = pa.list_(pa.list_(pa.int32()))
    types = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), kind, kind, pa.list_(pa.int64())]
    batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], ["cell", "share", "role", "doc_id", "b", "mine", "theirs", "tokens"])
    assert len(want) > 40
    for size, chunk in ((len(rows), 1_000_000), (1, 50), (5, 500)):
        monkeypatch.setattr(substring, "CHUNK", chunk)
        got, kept = set(), batch.slice(0, 0)
        for lo in range(0, len(rows), size):
            t = pa.Table.from_batches([kept, batch.slice(lo, size)]).combine_chunks().to_batches()[0]
            cols, open_ = substring.verified(t, least, 0.8)
            got |= set(zip(*(c.tolist() for c in cols)))
            kept = t.take(pa.array(open_))
        assert got == want
