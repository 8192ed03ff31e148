"""Secret scans over an incremental, content-addressed blob ledger.

Every version of every path is addressed by the SHA-256 of its text.  The
ledger records which rule versions have scanned which blob and what they found.
A run scans each unseen (blob, rule version) pair once, whatever number of
paths hold the blob, appends to the ledger and joins findings back to all
paths.  Findings carry the version of their rule: a new version takes the place of
the old one, whose findings no longer count.  Everything runs as DataFrame
expressions.

Spans are code-point offsets, end exclusive.  A rule's matches are leftmost and
non-overlapping; those failing its length are dropped after matching.  Offsets
come from cutting a text at the rule's matches: lengths of the pieces between
them and of the matches add up, as a running sum over the matches as rows, so that a
very long text with very many matches takes time in proportion.

Defined results: a null text is an empty text without findings; repeated rows
each get the findings of their blob; null ids are kept; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from samefold.llm import common


@dataclass(frozen=True)
class Rule:
    """A versioned rule: ``group`` of a match must have ``least`` characters."""

    kind: str
    version: int
    pattern: str
    hints: tuple[str, ...] = ()  # the lower-cased text holds one of these if it matches
    group: int = 0
    least: int = 0

    @property
    def key(self) -> str:
        return f"{self.kind}@{self.version}"


BASE = ("assign", "access", "hex")
RULES = (
    Rule("assign", 1, r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", ("passw", "secret", "token", "api"), 2, 8),
    Rule("access", 1, r"AKIA[A-Z0-9]{12,}", ("akia",)),
    Rule("hex", 1, r"[0-9a-f]{32,}"),
    Rule("github", 1, r"gh[oprsu]_[A-Za-z0-9]{36,}", ("gho_", "ghp_", "ghr_", "ghs_", "ghu_")),
    Rule("slack", 1, r"xox[abprs]-[A-Za-z0-9-]{10,}", ("xox",)),
    Rule("pem", 1, r"-----BEGIN [A-Z ]*PRIVATE KEY-----", ("private key",)),
    Rule("jwt", 1, r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", (".eyj",)),
)
SPAN = "array<struct<start:int,rank:int,kind:string,version:int,stop:int>>"
HIT = "array<struct<rank:int,i:int,gap:int,size:int,value:int>>"
LOWEST = -(1 << 63)
#: Code points of a block that a long text is cut into before its spans are masked.
BLOCK = 8192


def _hits(text: Column, rule: Rule, rank: int) -> Column:
    """Lengths of a rule's matches, of the pieces before them and of their values."""
    whole = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group))
    parts = F.split(text, rule.pattern, -1)
    zipped = F.arrays_zip(whole.alias("m"), value.alias("v"), F.slice(parts, 1, F.size(parts) - 1).alias("p"))
    return F.transform(zipped, lambda x, i: F.struct(F.lit(rank).alias("rank"), i.alias("i"), F.length(x["p"]).alias("gap"), F.length(x["m"]).alias("size"), F.length(x["v"]).alias("value")))


def _hinted(text: Column, lowered: Column, rule: Rule) -> Column:
    if not rule.hints:
        return text.rlike(rule.pattern)
    out = F.lit(False)
    for h in rule.hints:
        out = out | lowered.contains(h)
    return out


def hits_of(text: Column, lowered: Column, need: Column | None = None, rules=RULES) -> Column:
    """Matches of all rules, as lengths; only ``need`` rules run, and texts without a rule's hints skip its pattern."""
    none = F.array().cast(HIT)
    parts = []
    for rank, rule in enumerate(rules):
        on = _hinted(text, lowered, rule)
        if need is not None:
            on = F.array_contains(need, rule.key) & on
        parts.append(F.when(on, _hits(text, rule, rank)).otherwise(none))
    return F.concat(*parts)


def spans_of(hits: DataFrame, rules=RULES) -> DataFrame:
    """(blob, findings) from (blob, hits): running sums of the lengths give the offsets."""
    rows = hits.where(F.size("hits") > 0).select("blob", F.explode("hits").alias("x")).select("blob", "x.*")
    order = W.partitionBy("blob", "rank").orderBy("i")
    rows = rows.withColumn("stop", F.sum(F.col("gap") + F.col("size")).over(order).cast("int"))
    least, kind, version = (F.array(*[F.lit(getattr(r, name)) for r in rules]) for name in ("least", "kind", "version"))
    rows = rows.where(F.col("value") >= F.get(least, F.col("rank")))
    span = F.struct((F.col("stop") - F.col("size")).alias("start"), "rank", F.get(kind, F.col("rank")).alias("kind"), F.get(version, F.col("rank")).alias("version"), "stop")
    return rows.groupBy("blob").agg(F.collect_list(span).alias("findings"))


def blob_id(text: Column) -> Column:
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256))


def scan_unseen(docs: DataFrame, ledger: str, id_col="doc_id", text_col="text", rules=RULES) -> DataFrame:
    """Scan what the ledger lacks, append it, return (path_id, blob) of all rows."""
    spark = docs.sparkSession
    key = F.coalesce(F.col(id_col).cast("long"), F.lit(LOWEST)).alias("_key")
    blobs = docs.select(F.col(id_col).alias("path_id"), key, blob_id(F.col(text_col)).alias("blob"))
    blobs = common.staged(blobs, "versions")
    todo = blobs.groupBy("blob").agg(F.min("_key").alias("_key"))
    keys = F.array(*[F.lit(r.key) for r in rules])
    known = read_ledger(spark, ledger)
    if known is None:
        todo = todo.withColumn("need", keys)
    else:
        scanned = known.groupBy("blob").agg(F.array_distinct(F.flatten(F.collect_set("scanned"))).alias("scanned"))
        todo = todo.join(scanned, "blob", "left")
        todo = todo.withColumn("need", F.array_except(keys, F.coalesce("scanned", F.array().cast("array<string>")))).drop("scanned").where(F.size("need") > 0)
    texts = docs.select(key, F.coalesce(text_col, F.lit("")).alias("text")).withColumn("blob", blob_id(F.col("text")))
    fresh = texts.join(todo, ["blob", "_key"]).withColumn("lowered", F.lower("text"))
    fresh = fresh.select("blob", F.col("need").alias("scanned"), hits_of(F.col("text"), F.col("lowered"), F.col("need"), rules).alias("hits"))
    fresh = common.staged(fresh, "scanned")
    # one file set a run: a lost run leaves no blob marked as scanned without its findings
    rows = fresh.join(spans_of(fresh, rules), "blob", "left").select("blob", "scanned", F.coalesce("findings", F.array().cast(SPAN)).alias("findings"))
    rows.write.mode("append").parquet(ledger)
    common.dispose(fresh)
    return blobs.select("path_id", "blob")


def read_ledger(spark, ledger: str) -> DataFrame | None:
    """The rows (blob, scanned, findings) of all runs, or None before the first."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(ledger)
    if not path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
        return None
    return spark.read.schema(f"blob binary, scanned array<string>, findings {SPAN}").parquet(ledger)


def current_findings(spark, ledger: str, rules=RULES) -> DataFrame:
    """(blob, findings) of blobs with a span of a current rule version, as a table; by start, then rule order."""
    rank = F.create_map(*[x for i, r in enumerate(rules) for x in (F.lit(r.key), F.lit(i))])
    rows = read_ledger(spark, ledger).select("blob", F.explode("findings").alias("x")).select("blob", "x.*")
    rows = rows.withColumn("rank", F.try_element_at(rank, F.concat_ws("@", "kind", "version"))).where("rank IS NOT NULL").distinct()  # runs side by side may find the same
    found = rows.groupBy("blob").agg(F.array_sort(F.collect_list(F.struct("start", "rank", "kind", "version", "stop"))).alias("findings"))
    return common.staged(found, "findings")


def scan_history(docs: DataFrame, ledger: str | None = None, id_col="doc_id", text_col="text", rules=RULES) -> DataFrame:
    """Rows (path_id, findings), one for every row of ``docs``."""
    spark = docs.sparkSession
    at = ledger or common.shared_path(spark, "ledger")
    paths = scan_unseen(docs, at, id_col, text_col, rules)
    found = current_findings(spark, at, rules)
    if not ledger:
        common.remove(spark, at)
    return paths.join(found, "blob", "left").select("path_id", F.coalesce("findings", F.array().cast(SPAN)).alias("findings"))


def joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["stop"])), ",")


def _of_kind(kind: str):
    return lambda x: x["kind"] == kind


def secret_report(docs: DataFrame, id_col="doc_id", text_col="text") -> DataFrame:
    rows = scan_history(docs, None, id_col, text_col)
    base = F.filter("findings", lambda x: x["kind"].isin(*BASE))
    counts = [F.size(F.filter("findings", _of_kind(k))).cast("long").alias(f"n_{k}") for k in BASE]
    return rows.select(F.col("path_id").alias("doc_id"), *counts, F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("findings")).alias("spans"))


def redacted(text: Column, findings: Column) -> Column:
    """The text with every span replaced by ``[kind]``; overlaps count once."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<since:int,start:int,kind:string>>").alias("out"))

    def step(acc, x):
        cut = F.array(F.struct(acc["at"].alias("since"), x["start"].alias("start"), x["kind"].alias("kind")))
        return F.struct(F.greatest(acc["at"], x["stop"]).alias("at"), F.when(x["start"] >= acc["at"], F.concat(acc["out"], cut)).otherwise(acc["out"]).alias("out"))

    # short entries are gathered a thousand at a time, so that no list is copied once a hit
    block = 1000
    groups = F.transform(F.sequence(F.lit(0), F.floor((F.size(findings) - 1) / block).cast("int")), lambda i: F.slice(findings, i * block + 1, block))
    many = F.aggregate(groups, F.struct(F.lit(0).alias("at"), F.array().cast("array<array<struct<since:int,start:int,kind:string>>>").alias("out")),
                       lambda acc, g: F.aggregate(g, F.struct(acc["at"].alias("at"), start["out"].alias("out")), step, lambda a: F.struct(a["at"].alias("at"), F.concat(acc["out"], F.array(a["out"])).alias("out"))))
    # a substring is found by walking to it, so the text is cut into blocks first
    blocks = F.transform(F.sequence(F.lit(0), F.floor(F.length(text) / BLOCK).cast("int")), lambda i: F.substring(text, i * BLOCK + 1, F.lit(BLOCK)))

    def cut(b, since, to):
        i, j = F.floor(since / BLOCK).cast("int"), F.floor(to / BLOCK).cast("int")
        head = F.substring(F.get(b, i), since - i * BLOCK + 1, to - since)
        tail = F.concat(F.array_join(F.slice(b, i + 2, j - i - 1), ""), F.substring(F.get(b, j), F.lit(1), to - j * BLOCK))
        return F.concat(head, F.when(j > i, tail).otherwise(""))

    # computed once a text: the lists travel through a one-element array
    state = F.array(F.struct(F.flatten(many["out"]).alias("cuts"), many["at"].alias("at"), blocks.alias("blocks")))
    whole = F.transform(state, lambda z: F.concat(F.array_join(F.transform(z["cuts"], lambda x: F.concat(cut(z["blocks"], x["since"], x["start"]), F.lit("["), x["kind"], F.lit("]"))), ""), cut(z["blocks"], z["at"], F.length(text))))
    return F.get(whole, F.lit(0))


def redact(docs: DataFrame, ledger: str | None = None, id_col="doc_id", text_col="text", chars_col="n_chars") -> DataFrame:
    """``docs`` with found secrets masked; rows without findings are unchanged."""
    spark = docs.sparkSession
    at = ledger or common.shared_path(spark, "ledger")
    scan_unseen(docs, at, id_col, text_col)
    found = current_findings(spark, at)
    if not ledger:
        common.remove(spark, at)
    found = found.withColumnsRenamed({"blob": "_blob", "findings": "_found"})
    hit = docs.withColumn("_b", blob_id(F.col(text_col))).join(found, F.col("_b") == F.col("_blob"), "left")
    text = F.when(F.col("_found").isNull(), F.col(text_col)).otherwise(redacted(F.col(text_col), F.col("_found")))
    out = hit.withColumn(text_col, text)
    if chars_col in docs.columns:
        out = out.withColumn(chars_col, F.when(F.col("_found").isNull(), F.col(chars_col)).otherwise(F.length(text_col).cast(docs.schema[chars_col].dataType)))
    return out.select(*docs.columns)


ORACLE_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
m AS (
  SELECT doc_id, k.kind, k.rank, k.least, regexp_extract_all(t, k.pat, 0) AS whole, regexp_extract_all(t, k.pat, k.grp) AS val, string_split_regex(t, k.pat) AS parts
  FROM d CROSS JOIN (VALUES
    ('assign', 0, 8, 2, '(?i:(password|passwd|secret|token|api_?key))["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)'),
    ('access', 1, 16, 0, 'AKIA[A-Z0-9]+'),
    ('hex', 2, 32, 0, '[0-9a-f]{32,}'),
    ('github', 3, 0, 0, 'gh[oprsu]_[A-Za-z0-9]{36,}'),
    ('slack', 4, 0, 0, 'xox[abprs]-[A-Za-z0-9-]{10,}'),
    ('pem', 5, 0, 0, '-----BEGIN [A-Z ]*PRIVATE KEY-----'),
    ('jwt', 6, 0, 0, 'eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}')
  ) AS k(kind, rank, least, grp, pat)),
e AS (SELECT doc_id, kind, rank, least, whole, val, parts, unnest(range(1, len(whole) + 1)) AS i FROM m WHERE len(whole) > 0),
s AS (
  SELECT doc_id, kind, rank, sum(length(parts[i])) OVER w + coalesce(sum(length(whole[i])) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS a, length(whole[i]) AS n, length(val[i]) >= least AS ok
  FROM e WINDOW w AS (PARTITION BY doc_id, kind ORDER BY i)),
g AS (SELECT doc_id, kind, rank, a, kind || ':' || a::BIGINT || ':' || (a + n)::BIGINT AS span FROM s WHERE ok),
r AS (
  SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
    string_agg(span, ',' ORDER BY a, rank) FILTER (rank < 3) AS base, string_agg(span, ',' ORDER BY a, rank) AS spans
  FROM g GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access, coalesce(n_hex, 0)::BIGINT AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN r USING (doc_id)
"""
