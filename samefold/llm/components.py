"""Connected components of an edge table, by contraction with random priorities.

Each round hooks every node to its neighbour of lowest hashed priority (itself
included), relabels the edges and drops those inside a node.  Random priorities
shrink any graph by a constant factor a round, long chains and stars alike.
Nothing is collected; every round is written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from samefold.llm.common import dispose, staged


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of ``edges`` (u, v), staged; the smallest node names it."""
    edges = staged(edges.where("u <> v").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct(), "edges")
    nodes = edges.select(F.explode(F.array("u", "v")).alias("node")).distinct()
    labels = staged(nodes.select("node", F.col("node").alias("root")), "labels")
    seed = 0
    while not edges.isEmpty():
        seed += 1
        rank = lambda c: F.struct(F.xxhash64(F.lit(seed), c).alias("h"), F.col(c).alias("to"))
        both = edges.select(F.explode(F.array(F.struct(F.col("u").alias("a"), F.col("v").alias("b")), F.struct(F.col("v").alias("a"), F.col("u").alias("b")))).alias("e")).select("e.*")
        best = both.groupBy("a").agg(F.min(rank("b")).alias("near")).select("a", F.least("near", rank("a"))["to"].alias("to"))
        best = staged(best, "hooks")
        left, right = best.toDF("u", "u2"), best.toDF("v", "v2")
        moved = edges.join(left, "u").join(right, "v").select(F.least("u2", "v2").alias("u"), F.greatest("u2", "v2").alias("v"))
        new_edges = staged(moved.where("u <> v").distinct(), "edges")
        new_labels = staged(labels.join(best.toDF("root", "to"), "root", "left").select("node", F.coalesce("to", "root").alias("root")), "labels")
        for old in (edges, labels, best):
            dispose(old)
        edges, labels = new_edges, new_labels
    names = labels.groupBy("root").agg(F.min("node").alias("component"))
    out = staged(labels.join(names, "root").select("node", "component"), "components")
    for old in (edges, labels):
        dispose(old)
    return out
