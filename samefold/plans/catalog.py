"""Named queries of the record-linkage engine and their SQL twins.

``R`` collects the queries, ``SQL`` the statements; both are keyed by name.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from samefold.functions import text
from samefold.operators import blocking, evaluation, features, matching
from samefold.sources import fixtures, staging, tables
from samefold.sources.fixtures import ENTITIES_SQL, NORM, NUMBERED_SQL
from samefold.streaming.incremental import match_stream

R: dict = {}
SQL: dict[str, str] = {}
TOP = 20
#: An earlier, smaller rule set, the baseline of comparisons.
CORE = ("exact_name", "token12", "prefix5", "suffix4", "last_token", "name_token_overlap", "address_token_overlap")
ALL = blocking.V8


def query(name: str, sql: str | None = None):
    def put(f):
        R[name] = f
        if sql:
            SQL[name] = sql
        return f

    return put


def _docs(spark, d):
    return spark.read.parquet(f"{d}/documents.parquet")


def _pair(spark, d, kind="entities"):
    return fixtures.sides(getattr(fixtures, kind)(spark, d))


# --- scalar functions -------------------------------------------------------------
query("normalize_text", f"SELECT doc_id, md5({NORM.format('text')}) AS h, length({NORM.format('text')}) AS n FROM documents")(
    lambda s, d: _docs(s, d).select("doc_id", text.normalize_text(F.col("text")).alias("t")).select("doc_id", F.md5("t").alias("h"), F.length("t").cast("long").alias("n")))
_NOURL = NORM.replace("lower(coalesce({}, ''))", r"regexp_replace(lower(coalesce({}, '')), 'https?://\S+|www\.\S+', ' ', 'g')")
_LINKED = "'See https://x.org/' || doc_id || '?q=1 or www.y.net, ' || coalesce(text, '')"
query("normalize_urls", f"SELECT doc_id, md5({_NOURL.format('(' + _LINKED + ')')}) AS h, length({_NOURL.format('(' + _LINKED + ')')}) AS n FROM documents")(
    lambda s, d: _docs(s, d).select("doc_id", text.normalize_text(F.expr(_LINKED), urls=True).alias("t")).select("doc_id", F.md5("t").alias("h"), F.length("t").cast("long").alias("n")))
TOK = "list_filter(string_split({0}, ' '), lambda x: length(x) >= {1})"
NAME = TOK.format("name", 2)
query("tokens_positional", f"WITH {ENTITIES_SQL} SELECT entity_id, coalesce({NAME}[1], '') AS t1, coalesce({NAME}[2], '') AS t2, coalesce({NAME}[3], '') AS t3, coalesce({NAME}[-1], '') AS t_last FROM entities")(
    lambda s, d: fixtures.entities(s, d).withColumn("t", text.tokens(F.col("name"))).select("entity_id", *[text.token_at(F.col("t"), i).alias(n) for i, n in ((1, "t1"), (2, "t2"), (3, "t3"), (-1, "t_last"))]))
CMP = "replace(name, ' ', '')"


def _pre(n):
    return f"CASE WHEN length({CMP}) >= {n} THEN substr({CMP}, 1, {n}) ELSE '' END"


def _suf(n):
    return f"CASE WHEN length({CMP}) >= {n} THEN right({CMP}, {n}) ELSE '' END"


query("prefix_suffix_keys", f"WITH {ENTITIES_SQL} SELECT entity_id, {_pre(3)} AS p3, {_pre(5)} AS p5, {_suf(4)} AS s4 FROM entities")(
    lambda s, d: fixtures.entities(s, d).select("entity_id", text.prefix(F.col("name"), 3).alias("p3"), text.prefix(F.col("name"), 5).alias("p5"), text.suffix(F.col("name"), 4).alias("s4")))
NUM = r"regexp_extract(address, '\b([0-9]{1,6})\b', 1)"
query("first_number", f"WITH {NUMBERED_SQL} SELECT entity_id, {NUM} AS number FROM entities")(
    lambda s, d: fixtures.numbered(s, d).select("entity_id", text.first_number(F.col("address")).alias("number")))
NUMS = r"list_distinct(regexp_extract_all(address, '(\p{Nd}+)', 1))"
query("number_set", f"WITH {NUMBERED_SQL} SELECT entity_id, array_to_string(list_sort({NUMS}), ',') AS numbers FROM entities")(
    lambda s, d: fixtures.numbered(s, d).select("entity_id", F.array_join(F.array_sort(text.numbers(F.col("address"))), ",").alias("numbers")))
query("number_parts", f"WITH {NUMBERED_SQL} SELECT entity_id, array_to_string(list_sort(list_distinct(regexp_extract_all('1234567890 ' || address, '(\\p{{Nd}}{{1,8}})', 1))), ',') AS numbers FROM entities")(
    lambda s, d: fixtures.numbered(s, d).select("entity_id", F.array_join(F.array_sort(text.numbers(F.concat(F.lit("1234567890 "), "address"), 8)), ",").alias("numbers")))
GRAMS = f"CASE WHEN length({CMP}) >= 3 THEN list_distinct(list_transform(range(1, length({CMP}) - 1), lambda i: substr({CMP}, i, 3))) ELSE [] END"
query("char_3grams", f"WITH {ENTITIES_SQL} SELECT entity_id, array_to_string(list_sort({GRAMS}), ',') AS grams FROM entities")(
    lambda s, d: fixtures.entities(s, d).select("entity_id", F.array_join(F.array_sort(text.char_grams(F.col("name"))), ",").alias("grams")))
_CASE = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in text.COUNTRIES.items())
_COUNTRY_IN = "CASE n_nationkey % 4 WHEN 0 THEN ' USA ' WHEN 1 THEN 'United  States' WHEN 2 THEN 'IN' ELSE n_name END"
query("country_canonical", f"WITH c AS (SELECT n_nationkey, trim(regexp_replace(lower({_COUNTRY_IN}), '\\s+', ' ', 'g')) AS c FROM nation) SELECT n_nationkey, CASE c {_CASE} ELSE c END AS country FROM c")(
    lambda s, d: s.read.parquet(f"{d}/nation.parquet").select("n_nationkey", text.normalize_country(F.expr(_COUNTRY_IN)).alias("country")))
R["normalize_nfkc"] = lambda s, d: _docs(s, d).select("doc_id", F.md5(text.normalize_name(F.col("text"))).alias("h"), F.length(text.nfkc(F.col("text"))).alias("n"), text.normalize_country(F.col("lang"), fold=True).alias("country"))

# --- audits -----------------------------------------------------------------------
query("audit_sources", f"WITH {ENTITIES_SQL}, c AS (UNPIVOT (SELECT entity_id, name, address, country FROM entities) ON entity_id, name, address, country INTO NAME \"column\" VALUE v) SELECT \"column\", count(*) AS rows, count(*) FILTER (trim(v) = '') AS empty, round(count(*) FILTER (trim(v) = '') * 100.0::DOUBLE / count(*), 6) AS empty_pct, count(DISTINCT v) AS distinct_values, count(*) - count(DISTINCT v) AS duplicates FROM c GROUP BY 1")(
    lambda s, d: evaluation.audit(fixtures.entities(s, d).drop("src")))
query("audit_truth", f"WITH {ENTITIES_SQL}, t AS (SELECT sid, count(*) AS n FROM truth GROUP BY 1) SELECT least(4, coalesce(n, 0))::BIGINT AS matches, count(*) AS entities FROM s1 LEFT JOIN t ON entity_id = sid GROUP BY 1")(
    lambda s, d: evaluation.match_histogram(_pair(s, d)[0], fixtures.truth(s, d)))
query("top_countries", f"WITH {NUMBERED_SQL} SELECT country, count(*) AS n FROM entities GROUP BY 1 ORDER BY n DESC, country LIMIT 15")(
    lambda s, d: fixtures.numbered(s, d).groupBy("country").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "country").limit(15))
query("lower_name_duplicates", f"WITH {ENTITIES_SQL} SELECT lower(name) AS name, count(*) AS n FROM entities GROUP BY 1 HAVING count(*) > 1")(
    lambda s, d: fixtures.entities(s, d).groupBy(F.lower("name").alias("name")).agg(F.count("*").alias("n")).where("n > 1"))
query("scan_offset", f"WITH {ENTITIES_SQL} SELECT entity_id, name FROM entities ORDER BY entity_id LIMIT 25 OFFSET 50")(
    lambda s, d: tables.first_rows(fixtures.entities(s, d).select("entity_id", "name"), 25, "entity_id", 50))

# --- blocking ---------------------------------------------------------------------


def _t(i):
    return f"coalesce({NAME}[{i}], '')"


def _both(a, b):
    return f"CASE WHEN {a} <> '' AND {b} <> '' THEN {a} || chr(1) || {b} ELSE '' END"


_A4 = "list_filter(list_filter(string_split(address, ' '), lambda x: x <> '')[1:4], lambda x: length(x) >= 3)"
RULE_SQL = {
    "exact_name": "[name]", "token12": f"[{_both(_t(1), _t(2))}]", "token_number": f"[{_both(_t(1), NUM)}]",
    "token_address": f"list_transform({_A4}, lambda x: CASE WHEN {_t(1)} <> '' THEN {_t(1)} || chr(1) || x ELSE '' END)",
    "token2_address": f"list_transform({_A4}, lambda x: CASE WHEN {_t(2)} <> '' THEN {_t(2)} || chr(1) || x ELSE '' END)",
    "prefix5": f"[{_pre(5)}]", "name_token_overlap": NAME, "suffix4": f"[{_suf(4)}]", "address_token_overlap": TOK.format("address", 3), "last_token": f"[{_t(-1)}]",
    "address_number": f"[{NUM}]", "address_token": TOK.format("address", 4), "char_3gram_overlap": GRAMS, "two_tokens": NAME,
    "token1": f"[{_t(1)}]", "token2": f"[{_t(2)}]", "token3": f"[{_t(3)}]", "prefix3": f"[{_pre(3)}]", "address_number_any": NUMS,
}


def _keys_sql(side, rules):
    return " UNION ALL ".join(f"SELECT DISTINCT '{r}' AS rule, unnest({RULE_SQL[r]}) AS key, country, entity_id FROM {side}" for r in rules)


def hits_sql(rules, base=ENTITIES_SQL):
    least = "CASE rule " + " ".join(f"WHEN '{r}' THEN {blocking.RULES[r].least}" for r in rules) + " END"
    cap = "CASE rule " + " ".join(f"WHEN '{r}' THEN {blocking.RULES[r].cap}" for r in rules) + " END"
    w = "CASE rule " + " ".join(f"WHEN '{r}' THEN {blocking.RULES[r].weight}" for r in rules) + " END"
    return f"""WITH {base},
k1 AS (SELECT * FROM ({_keys_sql('s1', rules)}) WHERE key <> '' AND country <> ''),
ka AS (SELECT *, count(*) OVER (PARTITION BY rule, key, country) AS m FROM ({_keys_sql('s23', rules)}) WHERE key <> '' AND country <> ''),
hits AS (SELECT a.entity_id AS sid, b.entity_id AS cid, rule, count(*) AS n FROM k1 a JOIN ka b USING (rule, key, country) WHERE m <= ({cap}) GROUP BY ALL HAVING count(*) >= {least}),
scored AS (SELECT sid, cid, sum({w})::BIGINT AS block_score, max({w})::BIGINT AS top, sum(n)::BIGINT AS votes, string_agg(rule, ',' ORDER BY rule) AS block_rules FROM hits GROUP BY ALL),
cand AS (SELECT sid, cid, block_score, block_rules, row_number() OVER (PARTITION BY sid ORDER BY block_score DESC, cid)::INT AS block_rank FROM scored QUALIFY block_rank <= {TOP})
"""


def _hits(s, d, rules=ALL, kind="entities"):
    return blocking.hits(*_pair(s, d, kind), rules)


def _cand(s, d, rules=ALL, kind="entities"):
    return blocking.candidates(*_pair(s, d, kind), rules, TOP)


def _ranked(s, d, scheme="sum", rules=ALL):
    return blocking.scored_pairs(*_pair(s, d), rules, scheme)


def _true_hits(s, d, rules=ALL):
    return blocking.hits_of(fixtures.truth(s, d), *_pair(s, d), rules)


for _rule in blocking.RULES:
    _num = "number" in _rule
    query(f"block_{_rule}", hits_sql([_rule], NUMBERED_SQL if _num else ENTITIES_SQL) + "SELECT sid, cid, n FROM hits")(
        lambda s, d, r=_rule, k="numbered" if _num else "entities": _hits(s, d, [r], k).select("sid", "cid", "n"))
H = hits_sql(ALL)
CAP = "CASE rule " + " ".join(f"WHEN '{r}' THEN {blocking.RULES[r].cap}" for r in ALL) + " END"
query("oversized_blocks", H + f"SELECT rule, key, country, count(*) AS n FROM ka WHERE m > ({CAP}) GROUP BY ALL")(
    lambda s, d: blocking.oversized(blocking.keys(_pair(s, d)[1], ALL)))
query("rank_votes", H + "SELECT sid, cid, votes AS block_score, block_rules FROM scored")(lambda s, d: _ranked(s, d, "votes"))
query("rank_max", H + "SELECT sid, cid, top AS block_score, block_rules FROM scored")(lambda s, d: _ranked(s, d, "max"))
query("rank_sum", H + "SELECT sid, cid, block_score, block_rules FROM scored")(lambda s, d: _ranked(s, d))
query("block_topk", H + "SELECT * FROM cand")(lambda s, d: _cand(s, d))
_N1, _N2 = (TOK.format(f"{x}.name", 2) for x in "ab")
_D1, _D2 = (TOK.format(f"{x}.address", 3) for x in "ab")
_G1, _G2 = (NUMS.replace("address", f"{x}.address") for x in "ab")
_SN, _SA = f"len(list_distinct(list_intersect({_N1}, {_N2})))", f"len(list_distinct(list_intersect({_D1}, {_D2})))"
query("rank_bonus", H + f"""SELECT sid, cid, (block_score + CASE WHEN a.name = b.name AND a.name <> '' THEN 1000 ELSE 0 END + least(120, 30 * {_SN})
 + CASE WHEN len({_N1}) > 0 AND {_SN} = len(list_distinct({_N1})) THEN 80 ELSE 0 END + least(180, 30 * {_SA}) + CASE WHEN len(list_intersect({_G1}, {_G2})) > 0 THEN 300 ELSE 0 END
 + CASE WHEN {_SN} > 0 AND {_SA} > 0 THEN 250 ELSE 0 END + CASE WHEN a.address = b.address AND a.address <> '' THEN 500 ELSE 0 END)::BIGINT AS block_score, block_rules
 FROM scored JOIN s1 a ON sid = a.entity_id JOIN s23 b ON cid = b.entity_id""")(lambda s, d: blocking.bonus(_ranked(s, d), *_pair(s, d)))
query("rule_hits", H + "SELECT rule, count(DISTINCT sid) AS n_s1, count(*) AS n_pairs FROM hits GROUP BY 1")(lambda s, d: blocking.rule_hits(_hits(s, d)))
query("zero_candidates", H + "SELECT entity_id AS sid FROM s1 WHERE entity_id NOT IN (SELECT sid FROM cand)")(lambda s, d: blocking.without_candidates(_pair(s, d)[0], _cand(s, d)))
query("candidate_list_export", H + "SELECT sid, string_agg(cid, ',' ORDER BY block_rank) AS candidate_entity_ids FROM cand GROUP BY 1")(lambda s, d: tables.as_list(_cand(s, d), "candidate_entity_ids"))
query("additive_candidates", H + "SELECT DISTINCT sid, cid FROM hits WHERE rule = 'address_token_overlap' AND (sid, cid) NOT IN (SELECT (sid, cid) FROM hits WHERE rule = 'exact_name')")(
    lambda s, d: blocking.additional(_hits(s, d, ["address_token_overlap"]), _hits(s, d, ["exact_name"])))
query("block_tokens_any", f"""WITH {ENTITIES_SQL}, a AS (SELECT entity_id, country, list_distinct({NAME}[1:2]) AS t FROM s1 WHERE len({NAME}) >= 2)
SELECT a.entity_id AS sid, b.entity_id AS cid FROM a JOIN s23 b ON a.country = b.country AND list_has_all({TOK.format('b.name', 2)}, a.t)""")(lambda s, d: blocking.tokens_any(*_pair(s, d)))
query("block_number_contained", f"""WITH {NUMBERED_SQL} SELECT DISTINCT a.entity_id AS sid, b.entity_id AS cid FROM s1 a JOIN s23 b ON a.country = b.country AND list_contains({_N2}, {_N1}[1])
WHERE {NUM.replace('address', 'a.address')} <> '' AND contains(b.address, {NUM.replace('address', 'a.address')})""")(lambda s, d: blocking.contains_number(*_pair(s, d, "numbered")))
_P = "CASE WHEN length(replace({0}.name, ' ', '')) >= 3 THEN substr(replace({0}.name, ' ', ''), 1, 3) ELSE '' END"
_HALF = f"least(len(list_distinct({_N1})), len(list_distinct({_N2}))) > 0 AND {_SN} >= 0.5 * least(len(list_distinct({_N1})), len(list_distinct({_N2})))"
_NAT = f"{NUM.replace('address', 'a.address')} <> '' AND {NUM.replace('address', 'a.address')} = {NUM.replace('address', 'b.address')} AND {_SN} > 0"
query("block_prefix_residuals", f"WITH {ENTITIES_SQL} SELECT a.entity_id AS sid, b.entity_id AS cid, ({_HALF}) AS half_tokens, ({_NAT}) AS number_and_token FROM s1 a JOIN s23 b ON a.country = b.country AND {_P.format('a')} = {_P.format('b')} AND {_P.format('a')} <> '' WHERE ({_HALF}) OR ({_NAT})")(
    lambda s, d: blocking.prefix_residuals(*_pair(s, d)))
CONFIGS = {"exact": ["exact_name"], "names": ["exact_name", "token12", "prefix5"], "core": list(CORE), "all": list(ALL)}
KS = [50, 100, 150, 200]
_CONF = " UNION ALL ".join(f"SELECT '{c}' AS config, unnest({rs}) AS rule" for c, rs in CONFIGS.items())
_W = "CASE rule " + " ".join(f"WHEN '{r}' THEN {blocking.RULES[r].weight}" for r in ALL) + " END"
query("config_matrix", H + f""", conf AS ({_CONF}), kk AS (SELECT unnest({KS})::INT AS top_k), tt AS (SELECT DISTINCT sid, cid FROM truth), nt AS (SELECT sid, count(*) AS n_true FROM tt GROUP BY 1),
p AS (SELECT config, sid, cid, row_number() OVER (PARTITION BY config, sid ORDER BY sum({_W}) DESC, cid) AS r FROM hits JOIN conf USING (rule) GROUP BY config, sid, cid),
e AS (SELECT config, top_k, p.sid, count(*) AS n, count(tt.sid) AS hits FROM p JOIN kk ON r <= top_k LEFT JOIN tt ON p.sid = tt.sid AND p.cid = tt.cid GROUP BY ALL),
g AS (SELECT config, top_k, sum(hits) AS hits, count(*) FILTER (hits > 0) AS n_some, count(*) FILTER (hits = n_true) AS whole, sum(n) AS n, max(n) AS most, count(*) AS reached FROM e LEFT JOIN nt USING (sid) GROUP BY ALL),
z AS (SELECT (SELECT count(*) FROM tt) AS pairs, (SELECT count(*) FROM nt) AS entities, (SELECT count(*) FROM s1) AS records)
SELECT c.config, kk.top_k, round(coalesce(hits / greatest(pairs, 1), 0), 6)::DOUBLE AS pair_recall, round(coalesce(n_some / greatest(entities, 1), 0), 6)::DOUBLE AS entity_recall, round(coalesce(whole / greatest(entities, 1), 0), 6)::DOUBLE AS all_match_rate,
 round(coalesce(n / greatest(records, 1), 0), 6)::DOUBLE AS avg_candidates, coalesce(most, 0)::BIGINT AS max_candidates, (records - coalesce(reached, 0))::BIGINT AS zero_candidates
FROM (SELECT DISTINCT config FROM conf) c CROSS JOIN kk CROSS JOIN z LEFT JOIN g ON g.config = c.config AND g.top_k = kk.top_k""")(
    lambda s, d: (lambda x: x.withColumns({c: F.round(c, 6) for c in ("pair_recall", "entity_recall", "all_match_rate", "avg_candidates")}))(blocking.config_matrix(_hits(s, d), fixtures.truth(s, d), _pair(s, d)[0], CONFIGS, KS)))

# --- features, labels and decisions ----------------------------------------------------
_L = "string_split(regexp_replace({0}, '\\s+', ' ', 'g'), ' ')"
_W1, _W2, _V1, _V2 = (_L.format(c) for c in ("a.name", "b.name", "a.address", "b.address"))


def _exact(f):
    return f"(a.{f} = b.{f} AND a.{f} <> '')"


def _len_sql(f):
    return f"CASE WHEN {_exact(f)} THEN 100.0 WHEN length(a.{f}) = 0 OR length(b.{f}) = 0 THEN 0.0 ELSE 100.0::DOUBLE * least(length(a.{f}), length(b.{f})) / greatest(length(a.{f}), length(b.{f})) END"


def _ov_sql(equal, x, y):
    return f"CASE WHEN {equal} THEN 100.0 ELSE 100.0::DOUBLE * list_count(list_intersect({x}, {y})) / greatest(1, least(list_count({x}), list_count({y}))) END"


_BOTH = f"list_count(list_intersect({_W1}, {_W2}))"
_F1, _F2 = ("regexp_extract({}.address, '[0-9]+')".format(x) for x in "ab")
FEAT = f"""feat AS (SELECT sid, cid, block_rank,
 {_len_sql('name')} AS name_ratio, CASE WHEN {_exact('name')} THEN 100.0 WHEN position(split_part(a.name, ' ', 1) IN b.name) > 0 THEN 80.0 ELSE 0.0 END AS name_partial_ratio,
 CASE WHEN a.name = b.name THEN 100.0 ELSE 100.0::DOUBLE * {_BOTH} / greatest(1, list_count(list_distinct(list_concat({_W1}, {_W2})))) END AS name_token_sort_ratio,
 {_ov_sql('a.name = b.name', _W1, _W2)} AS name_token_set_ratio, {_exact('name')}::INT AS name_exact, abs(length(a.name) - length(b.name)) AS name_length_diff,
 {_len_sql('address')} AS address_ratio, {_ov_sql(_exact('address'), _V1, _V2)} AS address_partial_ratio, {_ov_sql('a.address = b.address', _V1, _V2)} AS address_token_set_ratio,
 {_exact('address')}::INT AS address_exact, abs(length(a.address) - length(b.address)) AS address_length_diff, {_exact('country')}::INT AS country_match,
 least(127, {_BOTH}) AS shared_token_count, {_BOTH}::DOUBLE / greatest(1, list_count({_W1})) AS shared_token_ratio,
 ({_F1} = {_F2} AND {_F1} <> '')::INT AS address_number_match, ({_F1} = {_F2} AND {_F1} <> '')::INT AS address_number_count, (100 - block_rank)::DOUBLE AS candidate_score, block_rank AS candidate_rank
 FROM cand JOIN s1 a ON sid = a.entity_id JOIN s23 b ON cid = b.entity_id)"""
_REAL = [c for c in features.FEATURES if c.endswith("ratio") or c == "candidate_score"]
_SEL = ", ".join(f"round({c}::DOUBLE, 6) AS {c}" if c in _REAL else f"{c}::BIGINT AS {c}" for c in features.FEATURES)


def _rounded(df):
    return df.select("sid", "cid", *[F.round(F.col(c).cast("double"), 6).alias(c) if c in _REAL else F.col(c).cast("long").alias(c) for c in features.FEATURES])


def _pairs(s, d, rules=ALL):
    return features.with_records(_cand(s, d, rules), *_pair(s, d))


query("features_proxy", H + f", {FEAT} SELECT sid, cid, {_SEL} FROM feat")(lambda s, d: _rounded(features.proxy(_pairs(s, d))))
_SCORE = "0.45::DOUBLE * name_token_set_ratio + 0.20::DOUBLE * name_ratio + 0.15::DOUBLE * name_partial_ratio + 0.10::DOUBLE * address_token_set_ratio + 0.05::DOUBLE * address_ratio + 5.0::DOUBLE * country_match + 3.0::DOUBLE * address_number_match"
PROB = f", {FEAT}, prob AS (SELECT *, round(({_SCORE}) / 108, 6) AS probability FROM feat)"


def _scored(s, d):
    p = features.proxy(_pairs(s, d))
    return p.withColumn("probability", F.round(features.candidate_score(p) / 108, 6)).withColumn("block_rank", F.col("candidate_rank"))


query("candidate_score_rank", H + PROB + ", r AS (SELECT sid, cid, round(probability * 108, 4) AS score, row_number() OVER (PARTITION BY sid ORDER BY probability DESC, block_rank) AS rank FROM prob) SELECT * FROM r WHERE rank <= 5")(
    lambda s, d: _scored(s, d).withColumn("rank", F.row_number().over(features.W.partitionBy("sid").orderBy(F.desc("probability"), "block_rank")).cast("long")).where("rank <= 5").select("sid", "cid", F.round(F.col("probability") * 108, 4).alias("score"), "rank"))
query("label_pairs", H + "SELECT c.sid, c.cid, (t.sid IS NOT NULL)::INT AS label FROM cand c LEFT JOIN truth t ON c.sid = t.sid AND c.cid = t.cid")(
    lambda s, d: matching.labelled(_cand(s, d).select("sid", "cid"), fixtures.truth(s, d)))
query("group_split", H + "SELECT sid, cid, ('0x' || substr(md5(sid), 1, 8))::BIGINT % 100 < 80 AS in_train FROM cand")(lambda s, d: matching.group_split(_cand(s, d).select("sid", "cid")))
query("decide_threshold", H + PROB + "SELECT sid, cid, probability FROM prob WHERE probability >= 0.5")(lambda s, d: matching.by_threshold(_scored(s, d)).select("sid", "cid", "probability"))
MARGIN = PROB + ", best AS (SELECT *, max(name_exact) OVER (PARTITION BY sid) AS e, max(probability) OVER (PARTITION BY sid) AS p FROM prob), kept AS (SELECT * FROM best WHERE CASE WHEN e = 1 THEN name_exact = 1 ELSE probability >= 0.5 AND p - probability <= 0.05 END)"
query("decide_exact_margin", H + MARGIN + "SELECT sid, cid, probability FROM kept")(lambda s, d: matching.by_margin(_scored(s, d), 0.5).select("sid", "cid", "probability"))
query("decide_rank", H + "SELECT sid, cid FROM cand WHERE block_rank <= 12")(lambda s, d: matching.by_rank(_cand(s, d)).select("sid", "cid"))
query("assemble_matches", H + MARGIN + "SELECT entity_id AS sid, coalesce(string_agg(cid, ',' ORDER BY substr(cid, 1, 2), probability DESC, cid), '') AS matched_entity_ids FROM s1 LEFT JOIN kept ON sid = entity_id GROUP BY 1")(
    lambda s, d: matching.assemble(_pair(s, d)[0], matching.by_margin(_scored(s, d), 0.5)))
query("best_second_margin", H + PROB + ", r AS (SELECT sid, probability, row_number() OVER (PARTITION BY sid ORDER BY probability DESC, cid) AS r FROM prob), g AS (SELECT sid, max(probability) FILTER (r = 1) AS best, coalesce(max(probability) FILTER (r = 2), 0.0) AS second FROM r GROUP BY 1) SELECT sid, best, second, round(best - second, 6) AS margin FROM g")(
    lambda s, d: evaluation.best_second(_scored(s, d)).withColumn("margin", F.round("margin", 6)))
THRESHOLDS = [0.1 * i for i in range(1, 10)]
query("threshold_sweep", H + PROB + f""", t AS (SELECT unnest({[round(x, 1) for x in THRESHOLDS]})::DOUBLE AS threshold), l AS (SELECT prob.probability, (tr.sid IS NOT NULL)::INT AS label, prob.sid FROM prob LEFT JOIN truth tr ON prob.sid = tr.sid AND prob.cid = tr.cid),
g AS (SELECT threshold, count(l.sid) AS predicted, coalesce(sum(label), 0)::BIGINT AS tp, (SELECT count(*) FROM truth) AS n FROM t LEFT JOIN l ON probability >= threshold GROUP BY 1),
m AS (SELECT *, CASE WHEN predicted > 0 THEN tp::DOUBLE / predicted ELSE 0 END AS p, CASE WHEN n > 0 THEN tp::DOUBLE / n ELSE 1 END AS r FROM g)
SELECT threshold, predicted, tp, predicted - tp AS fp, n - tp AS fn, round(p, 6) AS precision, round(r, 6) AS recall, round(CASE WHEN p + r > 0 THEN 1.25 * p * r / (0.25 * p + r) ELSE 0 END, 6) AS f05 FROM m""")(
    lambda s, d: (lambda x: x.withColumns({c: F.round(c, 6) for c in ("precision", "recall", "f05")}))(matching.sweep(_scored(s, d), fixtures.truth(s, d), [round(x, 1) for x in THRESHOLDS])))

# --- evaluation and validation -----------------------------------------------------------


def _entities_sql(found):
    return f""", p AS (SELECT DISTINCT sid, cid FROM {found}), tt AS (SELECT DISTINCT sid, cid FROM truth),
e AS (SELECT coalesce(tt.sid, p.sid) AS sid, count(tt.sid) AS n_true, count(p.sid) AS n_found, count(*) FILTER (tt.sid IS NOT NULL AND p.sid IS NOT NULL) AS n_hit FROM tt FULL JOIN p ON tt.sid = p.sid AND tt.cid = p.cid GROUP BY 1)"""


def _r6(df, *cols):
    return df.withColumns({c: F.round(c, 6) for c in cols})


query("recall_blocking", H + _entities_sql("cand") + """SELECT count(*) FILTER (n_true > 0) AS entities, round(sum(n_hit)::DOUBLE / greatest(sum(n_true), 1), 6) AS pair_recall,
 round(count(*) FILTER (n_true > 0 AND n_hit > 0)::DOUBLE / greatest(count(*) FILTER (n_true > 0), 1), 6) AS entity_recall, round(count(*) FILTER (n_true > 0 AND n_hit = n_true)::DOUBLE / greatest(count(*) FILTER (n_true > 0), 1), 6) AS all_match_rate,
 count(*) FILTER (n_true > 0 AND n_hit > 0 AND n_hit < n_true) AS partial, round(avg(n_found), 6) AS avg_candidates, max(n_found) AS max_candidates FROM e""")(
    lambda s, d: _r6(evaluation.blocking_recall(fixtures.truth(s, d), _cand(s, d)), "pair_recall", "entity_recall", "all_match_rate", "avg_candidates"))
query("pair_metrics", H + MARGIN + _entities_sql("kept") + """, g AS (SELECT sum(n_hit)::BIGINT AS tp, sum(n_found - n_hit)::BIGINT AS fp, sum(n_true - n_hit)::BIGINT AS fn, count(*) FILTER (n_hit > 0) AS h, count(*) FILTER (n_found > n_hit) AS x, count(*) FILTER (n_true > n_hit) AS y,
 avg((coalesce(n_hit, 0) = coalesce(n_true, 0) AND coalesce(n_hit, 0) = coalesce(n_found, 0))::INT) AS ex FROM e FULL JOIN s1 ON e.sid = s1.entity_id), m AS (SELECT *, CASE WHEN tp + fp > 0 THEN tp::DOUBLE / (tp + fp) ELSE 0 END AS p, CASE WHEN tp + fn > 0 THEN tp::DOUBLE / (tp + fn) ELSE 0 END AS r FROM g)
SELECT tp, fp, fn, round(p, 6) AS precision, round(r, 6) AS recall, round(CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END, 6) AS f1, round(CASE WHEN p + r > 0 THEN 1.25 * p * r / (0.25 * p + r) ELSE 0 END, 6) AS f05,
 round(CASE WHEN h + x > 0 THEN h::DOUBLE / (h + x) ELSE 0 END, 6) AS entity_precision, round(CASE WHEN h + y > 0 THEN h::DOUBLE / (h + y) ELSE 0 END, 6) AS entity_recall, round(ex, 6) AS exact_match_rate FROM m""")(
    lambda s, d: _r6(evaluation.pair_metrics(fixtures.truth(s, d), matching.by_margin(_scored(s, d), 0.5), _pair(s, d)[0]), "precision", "recall", "f1", "f05", "entity_precision", "entity_recall", "exact_match_rate"))
query("macro_f05", H + MARGIN + _entities_sql("kept") + """, a AS (SELECT coalesce(n_true, 0) AS t, coalesce(n_found, 0) AS f, coalesce(n_hit, 0) AS h FROM s1 LEFT JOIN e ON sid = entity_id), m AS (SELECT *, CASE WHEN f > 0 THEN h::DOUBLE / f ELSE 0 END AS p, CASE WHEN t > 0 THEN h::DOUBLE / t ELSE 1 END AS r FROM a)
SELECT count(*) AS entities, round(avg(CASE WHEN t = 0 AND f = 0 THEN 0 WHEN p + r > 0 THEN 1.25 * p * r / (0.25 * p + r) ELSE 0 END), 6) AS macro_f05 FROM m""")(
    lambda s, d: _r6(evaluation.macro_f05(_pair(s, d)[0], fixtures.truth(s, d), matching.by_margin(_scored(s, d), 0.5)), "macro_f05"))
query("rule_contribution", H + "SELECT rule, count(*) AS recovered FROM hits JOIN (SELECT DISTINCT sid, cid FROM truth) USING (sid, cid) GROUP BY 1")(lambda s, d: evaluation.rule_contribution(fixtures.truth(s, d), _true_hits(s, d)))
_PRI = "CASE rule " + " ".join(f"WHEN '{r}' THEN {i}" for i, r in enumerate(reversed(ALL))) + " END"
query("first_recovering_rule", H + f", f AS (SELECT sid, cid, arg_min(rule, {_PRI}) AS rule FROM hits JOIN (SELECT DISTINCT sid, cid FROM truth) USING (sid, cid) GROUP BY ALL) SELECT rule, count(*) AS pairs FROM f GROUP BY 1")(
    lambda s, d: evaluation.first_rule(fixtures.truth(s, d), _true_hits(s, d), list(reversed(ALL))))
query("fn_attribution", H + PROB + """SELECT CASE WHEN p.sid IS NOT NULL THEN 'found' WHEN c.sid IS NOT NULL THEN 'model' ELSE 'blocking' END AS stage, count(*) AS pairs FROM (SELECT DISTINCT sid, cid FROM truth) t
LEFT JOIN cand c ON t.sid = c.sid AND t.cid = c.cid LEFT JOIN (SELECT sid, cid FROM prob WHERE probability >= 0.9) p ON t.sid = p.sid AND t.cid = p.cid GROUP BY 1""")(
    lambda s, d: evaluation.missed_by(fixtures.truth(s, d), _cand(s, d), matching.by_threshold(_scored(s, d), 0.9)))
_CHECKS = {
    "same_country": "a.country = b.country AND a.country <> ''", "same_name": "a.name = b.name AND a.name <> ''", "same_address": "a.address = b.address AND a.address <> ''",
    **{k: f"coalesce({_N1}[{i}], '') = coalesce({_N2}[{i}], '') AND coalesce({_N1}[{i}], '') <> ''" for k, i in (("same_first", 1), ("same_second", 2), ("same_last", -1))},
    **{k: f"{e.replace('name', 'a.name')} = {e.replace('name', 'b.name')} AND {e.replace('name', 'a.name')} <> ''" for k, e in (("same_prefix3", _pre(3)), ("same_prefix5", _pre(5)), ("same_suffix4", _suf(4)))},
    "same_number": f"{NUM.replace('address', 'a.address')} = {NUM.replace('address', 'b.address')} AND {NUM.replace('address', 'a.address')} <> ''",
    "share_name_token": f"len(list_intersect({_N1}, {_N2})) > 0", "share_address_token": f"len(list_intersect({_D1}, {_D2})) > 0",
}
query("missed_profile", f"WITH {ENTITIES_SQL} SELECT count(*) AS pairs, " + ", ".join(f"count(*) FILTER ({v}) AS {k}" for k, v in _CHECKS.items()) + ", count(*) FILTER (" + " OR ".join(f"({v})" for k, v in _CHECKS.items() if k != "same_country") + ") AS reachable FROM truth JOIN s1 a ON sid = a.entity_id JOIN s23 b ON cid = b.entity_id")(
    lambda s, d: evaluation.profile(features.with_records(fixtures.truth(s, d), *_pair(s, d))))
query("topk_curve", H + ", h AS (SELECT block_rank FROM cand JOIN (SELECT DISTINCT sid, cid FROM truth) USING (sid, cid)), k AS (SELECT unnest([1, 5, 10, 20])::INT AS k) SELECT k, count(block_rank) AS recovered FROM k LEFT JOIN h ON block_rank <= k GROUP BY 1")(
    lambda s, d: evaluation.recovery_curve(fixtures.truth(s, d), _cand(s, d), [1, 5, 10, 20]))
_M = "m AS (SELECT entity_id AS sid, coalesce(string_agg(cid, ',' ORDER BY cid), '') AS matched_entity_ids FROM s1 LEFT JOIN kept ON sid = entity_id GROUP BY 1), x AS (SELECT sid, unnest(list_filter(string_split(matched_entity_ids, ','), lambda x: x <> '')) AS cid FROM m)"
query("validate_outputs", H + MARGIN + f", {_M}" + r"""SELECT 'duplicate_s1' AS "check", count(*) AS violations FROM (SELECT sid FROM m GROUP BY 1 HAVING count(*) > 1)
UNION ALL SELECT 'missing_s1', count(*) FROM s1 WHERE entity_id NOT IN (SELECT sid FROM m) UNION ALL SELECT 'unknown_s1', count(*) FROM m WHERE sid NOT IN (SELECT entity_id FROM s1)
UNION ALL SELECT 'malformed_s1', count(*) FROM m WHERE NOT regexp_matches(sid, '^S1-\d+$') UNION ALL SELECT 'malformed_match', count(*) FROM x WHERE NOT regexp_matches(cid, '^S[23]-\d+$')
UNION ALL SELECT 'duplicate_pair', count(*) FROM (SELECT 1 FROM x GROUP BY sid, cid HAVING count(*) > 1) UNION ALL SELECT 'match_not_candidate', count(*) FROM x WHERE (sid, cid) NOT IN (SELECT (sid, cid) FROM cand WHERE block_rank <= 2)
UNION ALL SELECT 'index_column', count(*) FROM m WHERE regexp_matches(sid, '^\d+$')""")(
    lambda s, d: evaluation.validate(_pair(s, d)[0], matching.assemble(_pair(s, d)[0], matching.by_margin(_scored(s, d), 0.5)), _cand(s, d).where("block_rank <= 2")))
query("diff_backup", H + """SELECT CASE WHEN a.sid IS NULL THEN 'added' WHEN b.sid IS NULL THEN 'removed' ELSE 'kept' END AS kind, count(*) AS pairs FROM (SELECT sid, cid FROM cand WHERE block_rank <= 3) a
FULL JOIN (SELECT sid, cid FROM scored WHERE top >= 350) b ON a.sid = b.sid AND a.cid = b.cid GROUP BY 1""")(
    lambda s, d: evaluation.diff(_cand(s, d).where("block_rank <= 3"), _ranked(s, d, "max").where("block_score >= 350")))
query("score_spread", H + PROB + "SELECT count(*) AS n, round(avg(probability), 6) AS mean, round(stddev(probability), 6) AS deviation, min(probability) AS least, max(probability) AS greatest, " + ", ".join(f"round(quantile_cont(probability, {q / 100}), 6) AS p{q}" for q in (10, 25, 50, 75, 90, 99)) + " FROM prob")(
    lambda s, d: _r6(evaluation.spread(_scored(s, d), "probability"), "mean", "deviation", *[f"p{q}" for q in (10, 25, 50, 75, 90, 99)]))


# --- reports, alignment and lookups ----------------------------------------------------
_BR = """SELECT count(*) FILTER (n_true > 0)::DOUBLE AS entities, sum(n_hit)::DOUBLE / greatest(sum(n_true), 1) AS pair_recall, count(*) FILTER (n_true > 0 AND n_hit > 0)::DOUBLE / greatest(count(*) FILTER (n_true > 0), 1) AS entity_recall,
 count(*) FILTER (n_true > 0 AND n_hit = n_true)::DOUBLE / greatest(count(*) FILTER (n_true > 0), 1) AS all_match_rate, count(*) FILTER (n_true > 0 AND n_hit > 0 AND n_hit < n_true)::DOUBLE AS partial, avg(n_found)::DOUBLE AS avg_candidates, max(n_found)::DOUBLE AS max_candidates"""
_OLD = "(SELECT sid, cid FROM cand WHERE block_rank <= 5)"
query("compare_recall", H + _entities_sql(_OLD) + f", o AS (UNPIVOT ({_BR} FROM e) ON COLUMNS(*) INTO NAME metric VALUE baseline)" + _entities_sql("cand").replace(" p AS", " p2 AS").replace("p.", "p2.").replace("JOIN p ", "JOIN p2 ").replace(", tt AS (SELECT DISTINCT sid, cid FROM truth)", "").replace("e AS (", "e2 AS (")
      + f", w AS (UNPIVOT ({_BR} FROM e2) ON COLUMNS(*) INTO NAME metric VALUE other) SELECT metric, round(baseline, 6) AS baseline, round(other, 6) AS other, round(other - baseline, 6) AS delta FROM o JOIN w USING (metric)")(
    lambda s, d: (lambda c: _r6(evaluation.compared(fixtures.truth(s, d), c.where("block_rank <= 5"), c), "baseline", "other", "delta"))(_cand(s, d)))
query("recall_averages", H + _entities_sql("cand") + """SELECT round(sum(coalesce(n_true, 0))::DOUBLE / greatest(count(*) FILTER (n_true > 0), 1), 6) AS avg_truth, round(avg(coalesce(n_hit, 0)), 6) AS avg_recovered, round(avg(coalesce(n_found, 0)), 6) AS avg_candidates,
 max(coalesce(n_found, 0))::BIGINT AS max_candidates, count(*) FILTER (coalesce(n_found, 0) = 0) AS zero_candidates, sum(coalesce(n_found, 0))::BIGINT AS total_candidates FROM s1 LEFT JOIN e ON sid = entity_id""")(
    lambda s, d: _r6(evaluation.recall_averages(_pair(s, d)[0], fixtures.truth(s, d), _cand(s, d)), "avg_truth", "avg_recovered", "avg_candidates"))
query("feature_recall", H + PROB + """, t AS (SELECT DISTINCT sid, cid FROM truth), g AS (SELECT t.sid, count(*) AS n, count(f.sid) AS h FROM t LEFT JOIN feat f ON t.sid = f.sid AND t.cid = f.cid GROUP BY 1)
SELECT (SELECT count(*) FROM feat) AS stage_rows, coalesce(sum(n), 0)::BIGINT AS truth_pairs, coalesce(sum(h), 0)::BIGINT AS recovered_pairs, round(sum(h)::DOUBLE / greatest(sum(n), 1), 6) AS pair_recall, round(count(*) FILTER (h > 0)::DOUBLE / greatest(count(*), 1), 6) AS entity_recall,
 round(count(*) FILTER (h >= n)::DOUBLE / greatest(count(*), 1), 6) AS all_match_rate, count(*) FILTER (h > 0 AND h < n) AS partial FROM g""")(
    lambda s, d: _r6(evaluation.stage_recall(fixtures.truth(s, d), features.proxy(_pairs(s, d))), "pair_recall", "entity_recall", "all_match_rate"))
LAB = PROB + ", lab AS (SELECT p.sid, p.cid, p.probability, (t.sid IS NOT NULL)::INT AS label FROM prob p LEFT JOIN (SELECT DISTINCT sid, cid FROM truth) t ON p.sid = t.sid AND p.cid = t.cid)"


def _labelled(s, d):
    return matching.labelled(_scored(s, d).select("sid", "cid", "probability"), fixtures.truth(s, d))


query("probability_by_truth", H + LAB + "SELECT label, count(*) AS n, min(probability) AS least, " + ", ".join(f"round(quantile_cont(probability, {q / 100}), 6) AS p{q}" for q in (25, 50, 75)) + ", max(probability) AS greatest, round(avg(probability), 6) AS mean FROM lab GROUP BY 1")(
    lambda s, d: _r6(evaluation.probability_by_truth(_labelled(s, d)), "p25", "p50", "p75", "mean"))
_CELLS = ", c AS (SELECT y.y AS label, p.p AS predicted, (SELECT count(*) FROM lab WHERE label = y.y AND (probability >= 0.9)::INT = p.p) AS n FROM (SELECT unnest([0, 1])::INT AS y) y CROSS JOIN (SELECT unnest([0, 1])::INT AS p) p)"
query("confusion_matrix", H + LAB + _CELLS + "SELECT * FROM c")(lambda s, d: matching.confusion(_labelled(s, d), 0.9))
query("classification_report", H + LAB + _CELLS + """, g AS (SELECT y, sum(n) FILTER (label = y AND predicted = y) AS tp, sum(n) FILTER (predicted = y) AS said, sum(n) FILTER (label = y) AS support FROM c CROSS JOIN (SELECT unnest([0, 1])::INT AS y) GROUP BY 1),
m AS (SELECT *, CASE WHEN said > 0 THEN tp::DOUBLE / said ELSE 0 END AS p, CASE WHEN support > 0 THEN tp::DOUBLE / support ELSE 0 END AS r FROM g)
SELECT y AS label, round(p, 6) AS precision, round(r, 6) AS recall, round(CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END, 6) AS f1, support::BIGINT AS support FROM m""")(
    lambda s, d: _r6(matching.class_report(_labelled(s, d), 0.9), "precision", "recall", "f1"))
query("score_areas", H + LAB + """, g AS (SELECT probability AS p, sum(label) AS pos, sum(1 - label) AS neg FROM lab GROUP BY 1), c AS (SELECT *, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp FROM g WINDOW w AS (ORDER BY p DESC ROWS UNBOUNDED PRECEDING))
SELECT round(sum(neg * (tp - pos / 2.0::DOUBLE)) / (sum(pos) * sum(neg)), 6) AS roc_auc, round(sum(pos * tp::DOUBLE / (tp + fp)) / sum(pos), 6) AS average_precision FROM c""")(
    lambda s, d: _r6(matching.score_areas(_labelled(s, d)), "roc_auc", "average_precision"))
query("missed_sample", H + "SELECT DISTINCT t.sid, t.cid FROM truth t WHERE (t.sid, t.cid) NOT IN (SELECT (sid, cid) FROM hits WHERE rule = 'address_number') ORDER BY sid, cid LIMIT 20")(
    lambda s, d: evaluation.missed_sample(fixtures.truth(s, d), _true_hits(s, d, ["address_number"])))
query("column_diff", "SELECT * FROM (VALUES ('business_name', 'missing', false), ('business_address', 'missing', false), ('entity_id', 'present', true), ('src', 'unexpected', false), ('name', 'unexpected', false), ('address', 'unexpected', false), ('country', 'present', false)) v(\"column\", state, in_place)")(
    lambda s, d: evaluation.column_diff(fixtures.entities(s, d), [f.name for f in tables.RECORD]))
query("result_summary", H + MARGIN + f", {_M}" + r""", l AS (SELECT sid, list_filter(string_split(matched_entity_ids, ','), lambda x: x <> '') AS ids FROM m),
k AS (SELECT len(ids) AS n, len(list_filter(ids, lambda x: regexp_matches(x, '^S2-\d+$'))) AS s2, len(list_filter(ids, lambda x: regexp_matches(x, '^S3-\d+$'))) AS s3 FROM l), z AS (SELECT entity_id, count(cid) AS n FROM s1 LEFT JOIN cand ON sid = entity_id GROUP BY 1),
a AS (SELECT count(*) AS rows, sum(s2)::BIGINT AS s2_ids, sum(s3)::BIGINT AS s3_ids, sum(n - s2 - s3)::BIGINT AS malformed_ids, count(*) FILTER (n > 0) AS matched_s1, round(avg((n > 0)::INT) * 100, 6) AS match_coverage FROM k)
SELECT a.*, min(n) AS min_candidates, round(avg(n), 6) AS avg_candidates, max(n) AS max_candidates, count(*) FILTER (n = 0) AS zero_candidates FROM z CROSS JOIN a GROUP BY ALL""")(
    lambda s, d: _r6(evaluation.result_summary(_pair(s, d)[0], matching.assemble(_pair(s, d)[0], matching.by_margin(_scored(s, d), 0.5)), _cand(s, d)), "match_coverage", "avg_candidates"))
query("lookup_completeness", H + "SELECT count(*) AS requested, count(b.entity_id) AS found, count(*) - count(b.entity_id) AS missing FROM (SELECT DISTINCT cid FROM cand) c LEFT JOIN (SELECT * FROM s23 WHERE src = 2) b ON cid = b.entity_id")(
    lambda s, d: evaluation.lookup_completeness(_cand(s, d), fixtures.entities(s, d).where("src = 2")))
query("alignment", H + """SELECT count(*) FILTER (a IS NOT NULL AND b IS NOT NULL) AS common, count(*) FILTER (b IS NULL) AS only_left, count(*) FILTER (a IS NULL) AS only_right, count(*) FILTER (a > 1 OR b > 1) AS repeated
FROM (SELECT entity_id AS sid, count(*) AS a FROM s1 GROUP BY 1) x FULL JOIN (SELECT sid, count(*) AS b FROM cand GROUP BY 1) y USING (sid)""")(
    lambda s, d: evaluation.alignment(_pair(s, d)[0], _cand(s, d)))
query("aligned_outputs", H + MARGIN + """SELECT entity_id AS sid, coalesce((SELECT string_agg(cid, ',' ORDER BY substr(cid, 1, 2), probability DESC, cid) FROM kept k WHERE k.sid = s1.entity_id), '') AS matched_entity_ids,
 coalesce((SELECT string_agg(cid, ',' ORDER BY substr(cid, 1, 2), block_rank, cid) FROM cand c WHERE c.sid = s1.entity_id), '') AS candidate_entity_ids FROM s1""")(
    lambda s, d: matching.aligned(_pair(s, d)[0], matching.by_margin(_scored(s, d), 0.5), _cand(s, d)))
query("candidate_list_parse", H + "SELECT sid, cid, block_rank FROM cand")(lambda s, d: tables.parsed_list(tables.as_list(_cand(s, d), "ids"), "ids"))
query("fetch_records", H + "SELECT entity_id, name, address, country FROM s23 WHERE entity_id IN (SELECT cid FROM cand WHERE block_rank <= 3)")(
    lambda s, d: tables.fetched(_pair(s, d)[1], _cand(s, d).where("block_rank <= 3").select(F.col("cid").alias("entity_id"))).select("entity_id", "name", "address", "country"))
query("keep_first", f"WITH {ENTITIES_SQL} SELECT entity_id, name, country FROM entities QUALIFY row_number() OVER (PARTITION BY name, country ORDER BY entity_id) = 1")(
    lambda s, d: tables.keep_first(fixtures.entities(s, d).select("entity_id", "name", "country"), ["name", "country"], ["entity_id"]))
query("group_sizes", f"WITH {ENTITIES_SQL} SELECT entity_id, count(*) OVER (PARTITION BY address, country) AS n FROM entities")(
    lambda s, d: (lambda e: e.join(e.groupBy("address", "country").agg(F.count("*").alias("n")), ["address", "country"]).select("entity_id", "n"))(fixtures.entities(s, d).select("entity_id", "address", F.coalesce("country", F.lit("")).alias("country"))))


@query("incremental_match", H + "SELECT sid, cid, block_score, block_rules, block_rank FROM cand")
def incremental_match(s, d):
    """S1 records that arrive as files are matched once each by a stream that runs until it has caught up."""
    s1, source = _pair(s, d)
    base = f"{staging.shared_dir(s)}/incremental-{staging.uuid.uuid4().hex}"
    s1.withColumn("arrival", F.pmod(F.xxhash64("entity_id"), F.lit(3)).cast("int")).write.partitionBy("arrival").parquet(f"{base}/in")
    match_stream(s, f"{base}/in/*", s1.schema, staging.staged(source, "source"), f"{base}/out", f"{base}/checkpoint", TOP, ALL, files_per_batch=4).awaitTermination()
    kinds = "sid string, cid string, block_score long, block_rules string, block_rank int"
    return s.read.schema(f"{kinds}, batch int").parquet(f"{base}/out").select("sid", "cid", "block_score", "block_rules", "block_rank")


# --- readers, writers and resumed work -------------------------------------------------
def _place(s, name):
    return f"{staging.shared_dir(s)}/{name}-{staging.uuid.uuid4().hex}"


_QUOTED = "'  \"' || name || '\", ' || address || ' '"  # quotes, separators and outer blanks must survive
query("tsv_roundtrip", f"WITH {ENTITIES_SQL} SELECT entity_id, {_QUOTED} AS business_name, address AS business_address, coalesce(country, '') AS country FROM entities")(
    lambda s, d: _written(s, fixtures.entities(s, d).select("entity_id", F.expr(_QUOTED).alias("business_name"), F.col("address").alias("business_address"), "country"), "\t", tables.RECORD))
query("csv_roundtrip_columns", f"WITH {ENTITIES_SQL} SELECT entity_id, {_QUOTED} AS label FROM entities")(
    lambda s, d: _written(s, fixtures.entities(s, d).select("entity_id", "country", F.expr(_QUOTED).alias("label")), ",", None, ["entity_id", "label"]))


def _written(s, df, sep, schema=None, columns=None):
    path = _place(s, "export")
    tables.write_delimited(df, path, sep)
    return tables.read_delimited(s, path, schema, sep, columns)


@query("record_aliases", f"WITH {ENTITIES_SQL} SELECT entity_id, name AS business_name, address AS business_address, coalesce(country, '') AS country FROM entities")
def record_aliases(s, d):
    """Records under other column spellings, in another order and beside a strange column."""
    path = _place(s, "aliases")
    e = fixtures.entities(s, d).select("src", F.col("country").alias("Nation"), F.col("address").alias("full_address"), F.col("name").alias("Company_Name"), F.col("entity_id").alias("record_id"))
    tables.write_delimited(e, path)
    return tables.read_records(s, path)


@query("candidate_layouts", H + "SELECT 'list' AS layout, sid, cid, block_rank::INT AS block_rank FROM cand UNION ALL SELECT 'pairs', sid, cid, block_rank::INT FROM cand")
def candidate_layouts(s, d):
    """Candidates written as lists and as pairs, each told apart by its header."""
    c = staging.staged(_cand(s, d).select("sid", "cid", "block_rank"), "candidates")
    lists, pairs = _place(s, "lists"), _place(s, "pairs")
    tables.write_delimited(tables.as_list(c, "candidate_entity_ids").withColumnRenamed("sid", "source1_entity_id"), lists)
    tables.write_delimited(c.toDF("source1_entity_id", "source_entity_id", "block_rank"), pairs)
    read = [tables.read_candidates(s, p).withColumn("layout", F.lit(n)).withColumn("block_rank", F.col("block_rank").cast("int")) for n, p in (("list", lists), ("pairs", pairs))]
    return read[0].unionByName(read[1])


@query("append_parts", f"WITH {ENTITIES_SQL} SELECT entity_id, name, address FROM s23")
def append_parts(s, d):
    """Two appends to one export; no header becomes a row."""
    path = _place(s, "appended")
    e = fixtures.entities(s, d)
    for src in (2, 3):
        tables.write_delimited(e.where(F.col("src") == src).select("entity_id", "name", "address"), path, mode="append")
    return tables.read_delimited(s, path, e.select("entity_id", "name", "address").schema)


query("resume_unfinished", H + "SELECT entity_id, name FROM s1 WHERE entity_id NOT IN (SELECT sid FROM cand WHERE block_score >= 2000)")(
    lambda s, d: tables.unfinished(_pair(s, d)[0], _cand(s, d).where("block_score >= 2000").select(F.col("sid").alias("entity_id")), "entity_id").select("entity_id", "name"))
query("truth_of_source", f"WITH {ENTITIES_SQL} SELECT DISTINCT sid, cid FROM truth WHERE cid LIKE 'S2-%'")(
    lambda s, d: tables.truth_pairs(fixtures.truth(s, d).groupBy(F.col("sid").alias("source1_entity_id")).agg(F.array_join(F.collect_list("cid"), " ; ").alias("matched_entity_ids")), "S2-"))


@query("cached_lookup", f"WITH {ENTITIES_SQL} SELECT entity_id, name, country FROM s23")
def cached_lookup(s, d):
    """A lookup table with a row guard: a copy with too few rows is built anew."""
    path, source = _place(s, "lookup"), _pair(s, d)[1].select("entity_id", "name", "country")
    n = source.count()
    staging.cached(s, path, 0, lambda: source.limit(0))
    return staging.require_unique(staging.cached(s, path, n, lambda: source), "entity_id")


for _name, _pattern, _how in (("normalize_ascii", r"[^a-z0-9_\s]", {"ascii_only": True}), ("normalize_marks", r"[^\p{L}\p{N}_\p{M}\s]", {"marks": True})):
    _sql = NORM.format("('Ça e' || chr(769) || 't_1 ' || coalesce(text, ''))").replace(r"[^\p{L}\p{N}_\s]", _pattern)
    query(_name, f"SELECT doc_id, md5({_sql}) AS h, length({_sql}) AS n FROM documents")(
        lambda s, d, how=_how: _docs(s, d).select("doc_id", text.normalize_text(F.concat(F.lit("Ça ét_1 "), F.coalesce("text", F.lit(""))), **how).alias("t")).select("doc_id", F.md5("t").alias("h"), F.length("t").cast("long").alias("n")))
query("recall_ceiling", H + """, t AS (SELECT DISTINCT sid, cid FROM truth), r AS (SELECT count(c.sid)::DOUBLE / greatest(count(*), 1) AS r FROM t LEFT JOIN cand c ON t.sid = c.sid AND t.cid = c.cid)
SELECT round(r, 6) AS pair_recall, round(CASE WHEN r > 0 THEN 1.25::DOUBLE * r / (0.25::DOUBLE + r) ELSE 0 END, 6) AS best_f05 FROM r""")(
    lambda s, d: _r6(evaluation.recall_ceiling(fixtures.truth(s, d), _cand(s, d)), "pair_recall", "best_f05"))
query("class_weights", H + """, lab AS (SELECT (t.sid IS NOT NULL)::INT AS label FROM cand c LEFT JOIN (SELECT DISTINCT sid, cid FROM truth) t ON c.sid = t.sid AND c.cid = t.cid), sums AS (SELECT sum(label) AS p, sum(1 - label) AS q FROM lab)
SELECT label, count(*) AS pairs, round(CASE WHEN label = 0 OR any_value(p) = 0 THEN 1 ELSE any_value(q)::DOUBLE / any_value(p) END, 6) AS weight FROM lab CROSS JOIN sums GROUP BY 1""")(
    lambda s, d: matching.class_weight(matching.labelled(_cand(s, d).select("sid", "cid"), fixtures.truth(s, d))).groupBy("label").agg(F.count("*").alias("pairs"), F.round(F.max("weight"), 6).alias("weight")))


# --- rows only -------------------------------------------------------------------------
R["features_fuzzy"] = lambda s, d: features.fuzzy(_pairs(s, d))


@query("train_predict_gbt")
def train_predict_gbt(s, d):
    """Train on 80 % of the S1 records, score the others."""
    pairs = staging.staged(matching.group_split(matching.labelled(features.proxy(_pairs(s, d)), fixtures.truth(s, d))), "pairs")
    model = matching.train(pairs.where("in_train"))
    return matching.predict(model, pairs.where("NOT in_train")).select("sid", "cid", "label", "probability")


def queries() -> dict:
    return dict(R)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
