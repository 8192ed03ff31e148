"""Labels, splits, the classifier and decision rules."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from samefold.operators.features import FEATURES


def labelled(pairs: DataFrame, truth: DataFrame) -> DataFrame:
    """Pairs with ``label`` 1 where the truth holds them."""
    t = truth.select("sid", "cid").distinct().withColumn("_t", F.lit(1))
    return pairs.join(t, ["sid", "cid"], "left").withColumn("label", F.coalesce("_t", F.lit(0))).drop("_t")


def bucket(c: Column, parts=100) -> Column:
    """Hash share of an id in [0, parts); equal in SQL engines that have MD5."""
    return F.conv(F.substring(F.md5(c), 1, 8), 16, 10).cast("long") % parts


def group_split(pairs: DataFrame, share=80) -> DataFrame:
    """``in_train`` by S1 record, so that no record is on both sides (M3)."""
    return pairs.withColumn("in_train", bucket(F.col("sid")) < share)


def class_weight(pairs: DataFrame) -> DataFrame:
    """``weight`` of positives is negatives over positives, 1 without any (M4)."""
    n = pairs.agg(F.sum("label").alias("p"), F.sum(1 - F.col("label")).alias("n"))
    ratio = F.when(F.col("p") > 0, F.col("n") / F.greatest("p", F.lit(1))).otherwise(1.0)
    return pairs.join(F.broadcast(n.select(ratio.alias("_r"))), F.lit(True)).withColumn("weight", F.when(F.col("label") == 1, F.col("_r")).otherwise(1.0)).drop("_r")


def train(pairs: DataFrame, trees=300, depth=6, step=0.08):
    """Gradient-boosted trees over the 18 features, in their order (M5, M7)."""
    missing = [c for c in FEATURES if c not in pairs.columns]
    if missing:
        raise ValueError(f"missing features {missing}")
    gbt = GBTClassifier(featuresCol="features", labelCol="label", weightCol="weight", maxIter=trees, maxDepth=depth, stepSize=step, subsamplingRate=0.8, featureSubsetStrategy="0.8", maxBins=256, minInstancesPerNode=2, seed=42)
    return Pipeline(stages=[VectorAssembler(inputCols=list(FEATURES), outputCol="features"), gbt]).fit(class_weight(pairs))


def predict(model, pairs: DataFrame) -> DataFrame:
    """Pairs with ``probability`` of a match (M6)."""
    got = model.transform(pairs.drop("probability"))
    return got.withColumn("probability", vector_to_array("probability")[1]).drop("features", "rawPrediction", "prediction")


def importance(model) -> list[tuple[str, float]]:
    """Features by falling importance (M8)."""
    return sorted(zip(FEATURES, model.stages[-1].featureImportances.toArray().tolist()), key=lambda x: (-x[1], x[0]))


def areas(scored: DataFrame) -> dict[str, float]:
    """Areas under the ROC and precision-recall curves."""
    return {m: BinaryClassificationEvaluator(rawPredictionCol="probability", labelCol="label", metricName=m).evaluate(scored) for m in ("areaUnderROC", "areaUnderPR")}


def by_threshold(scored: DataFrame, t=0.5) -> DataFrame:
    """Every pair that reaches the threshold (M9)."""
    return scored.where(F.col("probability") >= t)


def by_margin(scored: DataFrame, t=0.8, margin=0.05) -> DataFrame:
    """Exact names alone where there are any, else those near the best."""
    w = W.partitionBy("sid")
    out = scored.withColumn("_e", F.max("name_exact").over(w)).withColumn("_p", F.max("probability").over(w))
    keep = F.when(F.col("_e") == 1, F.col("name_exact") == 1).otherwise((F.col("probability") >= t) & (F.col("_p") - F.col("probability") <= margin))
    return out.where(keep).drop("_e", "_p")


def by_rank(pairs: DataFrame, n=12) -> DataFrame:
    """The first ``n`` by block rank, without a model."""
    return pairs.where(F.col("block_rank") <= n)


def assemble(s1: DataFrame, pairs: DataFrame, out="matched_entity_ids") -> DataFrame:
    """One row per S1 record, empty where nothing matched; S2 before S3."""
    w = F.struct(F.substring("cid", 1, 2).alias("s"), (-F.col("probability")).alias("p"), "cid")
    lists = pairs.groupBy("sid").agg(F.array_join(F.array_distinct(F.transform(F.array_sort(F.collect_list(w)), lambda x: x["cid"])), ",").alias(out))
    return s1.select(F.col("entity_id").alias("sid")).join(lists, "sid", "left").fillna("", [out])


def sweep(scored: DataFrame, truth: DataFrame, thresholds: list[float]) -> DataFrame:
    """Pair counts and scores at every threshold in one pass."""
    hit = labelled(scored.select("sid", "cid", "probability"), truth)
    at = [(float(t), F.col("probability") >= float(t)) for t in thresholds]
    sums = F.array(*[F.struct(F.lit(t).alias("threshold"), F.coalesce(F.sum(c.cast("long")), F.lit(0).cast("long")).alias("predicted"), F.coalesce(F.sum(F.when(c, F.col("label").cast("long"))), F.lit(0).cast("long")).alias("tp")) for t, c in at])
    got = hit.agg(sums.alias("x")).select(F.explode("x").alias("x")).select("x.*")
    out = got.join(F.broadcast(truth.distinct().agg(F.count("*").alias("n_true"))), F.lit(True))
    p = F.when(F.col("predicted") > 0, F.col("tp") / F.greatest("predicted", F.lit(1))).otherwise(0.0)
    r = F.when(F.col("n_true") > 0, F.col("tp") / F.greatest("n_true", F.lit(1))).otherwise(1.0)
    return out.select("threshold", "predicted", "tp", (F.col("predicted") - F.col("tp")).alias("fp"), (F.col("n_true") - F.col("tp")).alias("fn"), p.alias("precision"), r.alias("recall"), f_beta(p, r).alias("f05"))


def confusion(scored: DataFrame, t=0.5) -> DataFrame:
    """(label, predicted, n) of the four cells, zeros included."""
    hit = F.coalesce((F.col("probability") >= t).cast("int"), F.lit(0))
    cells = F.array(*[F.struct(F.lit(y).alias("label"), F.lit(p).alias("predicted"), F.coalesce(F.sum(((F.col("label") == y) & (hit == p)).cast("long")), F.lit(0).cast("long")).alias("n")) for y in (0, 1) for p in (0, 1)])
    return scored.agg(cells.alias("x")).select(F.explode("x").alias("x")).select("x.*")


def class_report(scored: DataFrame, t=0.5) -> DataFrame:
    """(label, precision, recall, f1, support) of both classes."""
    c = confusion(scored, t)
    right = F.sum(F.when((F.col("label") == F.col("y")) & (F.col("predicted") == F.col("y")), F.col("n")).otherwise(0))
    said, held = F.sum(F.when(F.col("predicted") == F.col("y"), F.col("n")).otherwise(0)), F.sum(F.when(F.col("label") == F.col("y"), F.col("n")).otherwise(0))
    g = c.withColumn("y", F.explode(F.array(F.lit(0), F.lit(1)))).groupBy("y").agg(right.alias("tp"), said.alias("said"), held.alias("support"))
    p, r = (F.when(F.col(x) > 0, F.col("tp") / F.greatest(x, F.lit(1))).otherwise(0.0) for x in ("said", "support"))
    return g.select(F.col("y").alias("label"), p.alias("precision"), r.alias("recall"), f_beta(p, r, 1.0).alias("f1"), "support")


def score_areas(scored: DataFrame) -> DataFrame:
    """(roc_auc, average_precision) of rounded probabilities.

    Counts per distinct probability come first, so that the running sums go over
    at most a million rows, whatever the number of pairs.
    """
    g = scored.groupBy(F.round("probability", 6).alias("p")).agg(F.sum("label").alias("pos"), F.sum(1 - F.col("label")).alias("neg"))
    down = W.orderBy(F.desc("p")).rowsBetween(W.unboundedPreceding, 0)
    g = g.withColumns({"tp": F.sum("pos").over(down), "fp": F.sum("neg").over(down)})
    a = g.agg(F.sum("pos").alias("n1"), F.sum("neg").alias("n0"), F.sum(F.col("neg") * (F.col("tp") - F.col("pos") / 2)).alias("area"), F.sum(F.col("pos") * F.col("tp") / (F.col("tp") + F.col("fp"))).alias("ap"))
    both = (F.col("n1") > 0) & (F.col("n0") > 0)
    return a.select(F.when(both, F.col("area") / (F.col("n1") * F.col("n0"))).alias("roc_auc"), F.when(F.col("n1") > 0, F.col("ap") / F.col("n1")).alias("average_precision"))


def save(model, path: str) -> None:
    """Write a fitted model to a shared folder (IO21)."""
    model.write().overwrite().save(path)


def load(path: str):
    """A saved model, refused if its features are not ours in our order (IO21, M7)."""
    model = PipelineModel.load(path)
    found = model.stages[0].getInputCols()
    if list(found) != list(FEATURES):
        raise ValueError(f"model features {found}")
    return model


def aligned(s1: DataFrame, pairs: DataFrame, candidates: DataFrame) -> DataFrame:
    """(sid, matched_entity_ids, candidate_entity_ids), one row per S1 record (IO20).

    Both lists go S2 before S3; every match must be a candidate.
    """
    order = candidates.select("sid", "cid", (-F.col("block_rank")).cast("double").alias("probability"))
    return assemble(s1, pairs).join(assemble(s1, order, "candidate_entity_ids"), "sid")


def require_candidates(pairs: DataFrame, candidates: DataFrame) -> DataFrame:
    """``pairs``, or an error if one of them is no candidate (M12, VC6)."""
    n = pairs.join(candidates.select("sid", "cid"), ["sid", "cid"], "left_anti").count()
    if n:
        raise ValueError(f"{n} matches are no candidates")
    return pairs


def f_beta(p: Column, r: Column, beta=0.5) -> Column:
    b = beta * beta
    return F.when(p + r > 0, (1 + b) * p * r / F.when(b * p + r > 0, b * p + r).otherwise(1.0)).otherwise(0.0)
