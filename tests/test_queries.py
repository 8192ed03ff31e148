import hashlib
import unicodedata

import __spark_entry__ as entry
import duckdb
import pytest
import regex
from samefold.operators import matching, tiles
from samefold.plans import catalog

SF = "/root/testdata/sf0.001"
NAMES = [n for n in entry.queries() if not n.startswith("op") and n != "pipeline"]


def cells(rows):
    return sorted([tuple(round(float(v), 6) if isinstance(v, (int, float)) or hasattr(v, "as_tuple") else v for v in r) for r in rows], key=str)


@pytest.mark.parametrize("name", [n for n in NAMES if n in entry.oracle_sql()])
def test_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "part", "nation"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df = entry.queries()[name](spark, SF)
    want = con.execute(entry.oracle_sql()[name]).df()
    cols = sorted(df.columns)
    assert cols == sorted(want.columns)
    assert cells(tuple(r[c] for c in cols) for r in df.collect()) == cells(want[cols].itertuples(index=False, name=None))


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_folding_equals_unicodedata(spark):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = entry.queries()["normalize_nfkc"](spark, SF).collect()
    assert len(got) == len(docs)
    for r in got:
        t = unicodedata.normalize("NFKC", docs[r.doc_id].text or "")
        folded = regex.sub(r"https?://\S+|www\.\S+", " ", t.casefold())
        plain = " ".join(regex.sub(r"[^\p{L}\p{M}\p{N}\s]", " ", folded).split())
        assert r.n == len(t) and r.h == hashlib.md5(plain.encode()).hexdigest()


@pytest.mark.parametrize("name", ["normalize_nfkc", "features_fuzzy"])
def test_rows_only(spark, name):
    assert entry.queries()[name](spark, SF).count() > 0


def test_blocks_over_50_rows_are_kept(spark, tmp_path):
    docs = [(i, "one two three four five six seven", "en") for i in range(180)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string").write.parquet(str(tmp_path / "documents.parquet"))
    assert entry.queries()["block_exact_name"](spark, str(tmp_path)).count() == 60 * 120
    assert entry.queries()["oversized_blocks"](spark, str(tmp_path)).count() == 0
    assert entry.queries()["block_topk"](spark, str(tmp_path)).count() == 60 * 20


def test_fuzzy_features_keep_20_candidates(spark, tmp_path):
    docs = [(i, "one two three four five six seven", "en") for i in range(180)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string").write.parquet(str(tmp_path / "documents.parquet"))
    got = entry.queries()["features_fuzzy"](spark, str(tmp_path)).groupBy("sid").count().collect()
    assert [r["count"] for r in got] == [20] * 60


def test_gbt_is_trained_at_full_size(spark, monkeypatch):
    asked, train = [], matching.train
    monkeypatch.setattr(matching, "train", lambda pairs, **options: asked.append(options) or train(pairs, trees=2, depth=2))
    got = entry.queries()["train_predict_gbt"](spark, SF).collect()
    assert asked == [{}] and train.__defaults__[:2] == (300, 6)
    assert got and all(0 <= r.probability <= 1 for r in got)


def test_character_grams_bring_misspelt_names_together(spark, tmp_path):
    docs = [(0, "akmehardwareshops", "en"), (1, "acmehardwareshop", "en")]
    spark.createDataFrame(docs, "doc_id long, text string, lang string").write.parquet(str(tmp_path / "documents.parquet"))
    got = entry.queries()["features_fuzzy"](spark, str(tmp_path)).collect()
    assert [(r.sid, r.cid) for r in got] == [("S1-0", "S2-1")]


#: What leaves the tiles of a query: the scheme, and how many pairs of an S1 record.
LEAVES = {
    "alignment": {("sum", catalog.TOP)},
    "assemble_matches": {("sum", catalog.TOP)},
    "best_second_margin": {("sum", catalog.TOP)},
    "block_char_3gram_overlap": {("hits", None)},
    "block_topk": {("sum", catalog.TOP)},
    "candidate_layouts": {("sum", catalog.TOP)},
    "candidate_list_export": {("sum", catalog.TOP)},
    "candidate_list_parse": {("sum", catalog.TOP)},
    "candidate_score_rank": {("sum", catalog.TOP)},
    "classification_report": {("sum", catalog.TOP)},
    "decide_threshold": {("sum", catalog.TOP)},
    "features_proxy": {("sum", catalog.TOP)},
    "fetch_records": {("sum", catalog.TOP)},
    "first_recovering_rule": set(),
    "group_split": {("sum", catalog.TOP)},
    "label_pairs": {("sum", catalog.TOP)},
    "lookup_completeness": {("sum", catalog.TOP)},
    "macro_f05": {("sum", catalog.TOP)},
    "pair_metrics": {("sum", catalog.TOP)},
    "probability_by_truth": {("sum", catalog.TOP)},
    "rank_max": {("max", None)},
    "rank_sum": {("sum", None)},
    "rank_votes": {("votes", None)},
    "recall_averages": {("sum", catalog.TOP)},
}


@pytest.mark.parametrize("name", LEAVES)
def test_pairs_stay_in_their_tiles(spark, monkeypatch, name):
    calls, meet = [], tiles.meet
    monkeypatch.setattr(tiles, "meet", lambda *a: calls.append(a[3:5]) or meet(*a))
    catalog.R[name](spark, SF)
    assert set(calls) == LEAVES[name]
