"""Mixing sources to target weights by Poisson replication.

A source with ``n`` of ``N`` rows and target weight ``w`` gets the mean rate
``w * N / n``.  Each row's count inverts the Poisson distribution of that rate
at a uniform number hashed from its id and a seed, so a row's count never
depends on the partitioning, on other rows or on a retry.  The high rate of a
rare source is cut into equal parts of at most ``PART_RATE``, each with a uniform
number of its own; their counts add up to a Poisson count of the whole rate.  Copies are exploded
and dealt to partitions in the order of a second hash: a global shuffle.

Defined results: a null source is a source of its own; a null id hashes as the
empty text; repeated rows get equal counts and are told apart by nothing but
their order key; sources with zero or missing weight get no copy; an empty table
gives an empty result; all columns are carried along, but for ones named
``copy_number`` or ``order_key``, which are replaced.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from samefold.llm import common

SEED = 20240917
#: Highest rate inverted in one go, so that tables stay short and exp(-rate) is no underflow.
PART_RATE = 200
#: Copies of a row exploded from one array.
COPY_BLOCK = 1024
#: Rows of the input for each partition of the output.
TASK_ROWS = 50_000


def uniform(seed: str, *cols) -> "F.Column":
    """A number in [0, 1) from the first 52 bits of an MD5 of seed and columns."""
    text = F.concat_ws(":", F.lit(seed), *[F.coalesce(c.cast("string"), F.lit("")) for c in cols])
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def rates(docs: DataFrame, source_col="source", weights: DataFrame | None = None) -> DataFrame:
    """Rows (source, rate); weights are (source, weight), equal when not given.

    A row per source; stays a DataFrame, as sources may be many.
    """
    sizes = docs.groupBy(F.col(source_col).alias("source")).agg(F.count("*").alias("n"))
    if weights is None:
        sizes = sizes.withColumn("weight", F.lit(1.0))
    else:
        w = weights.select(F.col("source").alias("_s"), F.col("weight").cast("double").alias("weight"))
        sizes = sizes.join(w, F.col("source").eqNullSafe(F.col("_s")), "left").drop("_s").fillna(0.0, ["weight"])
    total = sizes.agg(F.sum("n").alias("rows"), F.sum("weight").alias("weights"))
    return sizes.crossJoin(F.broadcast(total)).select("source", (F.col("weight") / F.col("weights") * F.col("rows") / F.col("n")).alias("rate"))  # `total` is one row


def poisson_table(rate) -> "F.Column":
    """P(X <= k) for k = 0, 1, ... far into the tail, from one rate column."""
    start = F.struct(F.exp(-rate).alias("p"), F.array(F.exp(-rate)).alias("c"))
    steps = F.sequence(F.lit(1), F.greatest(F.lit(16), F.ceil(rate * 2 + F.sqrt(rate) * 10).cast("int")))

    def add(acc, k):
        p = acc.p * rate / k
        return F.struct(p.alias("p"), F.concat(acc.c, F.array(F.element_at(acc.c, -1) + p)).alias("c"))

    return F.aggregate(steps, start, add, lambda acc: acc.c)


def replicated(docs: DataFrame, id_col="doc_id", source_col="source", weights: DataFrame | None = None, seed=SEED) -> DataFrame:
    """``docs`` with ``copy_number`` (from 0) and ``order_key``, unshuffled."""
    table = rates(docs, source_col, weights).withColumn("_parts", F.greatest(F.lit(1), F.ceil(F.col("rate") / PART_RATE).cast("int")))
    table = table.select(F.col("source").alias("_source"), "_parts", poisson_table(F.col("rate") / F.col("_parts")).alias("_cdf"))
    rows = docs.join(F.broadcast(table) if _few(table) else table, F.col(source_col).eqNullSafe(F.col("_source")))

    def drawn(u):
        return F.size(F.filter("_cdf", lambda c: c <= u))

    first = drawn(uniform(f"{seed}", F.col(id_col)))
    further = F.aggregate(F.sequence(F.lit(1), F.col("_parts") - 1), first.cast("long"), lambda n, i: n + drawn(uniform(f"{seed}", F.col(id_col), i)))
    rows = rows.withColumn("_n", F.when(F.col("_parts") == 1, first.cast("long")).otherwise(further)).where("_n > 0")
    rows = rows.withColumn("_from", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_n") - 1, F.lit(COPY_BLOCK).cast("long"))))
    rows = rows.withColumn("copy_number", F.explode(F.sequence(F.col("_from").cast("int"), (F.least(F.col("_from") + COPY_BLOCK, F.col("_n")) - 1).cast("int"))))
    return rows.withColumn("order_key", uniform(f"{seed}-order", F.col(id_col), F.col("copy_number"))).drop("_n", "_from", "_parts", "_cdf", "_source")


def _few(table: DataFrame, bound=10_000) -> bool:
    return table.limit(bound + 1).count() <= bound


def mix(docs: DataFrame, id_col="doc_id", source_col="source", weights: DataFrame | None = None, seed=SEED) -> DataFrame:
    """Replicated rows in global random order (range-dealt by ``order_key``)."""
    out = replicated(docs, id_col, source_col, weights, seed)
    spark = docs.sparkSession
    parts = common.parts(spark, docs.count(), TASK_ROWS)
    # hash keys are uniform, so equal intervals are equal shares: no sampling pass
    return out.repartitionById(parts, F.floor(F.col("order_key") * parts).cast("int")).sortWithinPartitions("order_key")


def poisson_count(rate: float, u: float) -> int:
    """Reference inversion, for tests."""
    p = c = math.exp(-rate)
    k = 0
    while c <= u and k < max(16, math.ceil(rate * 2 + math.sqrt(rate) * 10)) + 1:
        k += 1
        p *= rate / k
        c += p
    return k


ORACLE_SQL = f"""
WITH RECURSIVE
n AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
w AS (SELECT source, 1.0::DOUBLE / (SELECT count(*) FROM n) * (SELECT sum(n) FROM n) / n AS rate FROM n),
r AS (SELECT source, parts, rate / parts AS rate FROM (SELECT *, greatest(1, ceil(rate / {PART_RATE}))::INT AS parts FROM w)),
p AS (
  SELECT source, rate, 0 AS k, exp(-rate) AS p, exp(-rate) AS c FROM r
  UNION ALL
  SELECT source, rate, k + 1, p * rate / (k + 1), c + p * rate / (k + 1) FROM p
  WHERE k < greatest(16, ceil(rate * 2 + sqrt(rate) * 10))),
u AS (
  SELECT *, ('0x' || substr(md5('{SEED}:' || coalesce(doc_id::VARCHAR, '') || CASE WHEN part > 0 THEN ':' || part ELSE '' END), 1, 13))::BIGINT::DOUBLE / 4503599627370496 AS u
  FROM (SELECT d.*, unnest(range(parts)) AS part FROM documents d JOIN r ON d.source IS NOT DISTINCT FROM r.source)),
x AS (
  SELECT u.doc_id, any_value(u.text) AS text, any_value(u.lang) AS lang, any_value(u.source) AS source, any_value(u.n_chars) AS n_chars, count(*) AS copies
  FROM u JOIN p ON u.source IS NOT DISTINCT FROM p.source AND p.c <= u.u GROUP BY u.doc_id),
y AS (SELECT x.*, unnest(range(copies))::INT AS copy_number FROM x)
SELECT doc_id, text, lang, source, n_chars, copy_number,
  ('0x' || substr(md5('{SEED}-order:' || coalesce(doc_id::VARCHAR, '') || ':' || copy_number), 1, 13))::BIGINT::DOUBLE / 4503599627370496 AS order_key
FROM y
"""
