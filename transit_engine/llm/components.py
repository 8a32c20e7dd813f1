"""Connected components by contraction.

Each round every node points to the neighbour (or itself) that comes first in an order drawn anew
for the round, pointers are followed, and the edges are rewritten between the nodes that are left.
A drawn order leaves chains of logarithmic length and takes away a constant share of the nodes, so
the rounds grow with the logarithm of the input. A node of very many edges costs one partially
aggregated minimum. Every round is written to the shared folder, in files that follow its rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from transit_engine.llm.common import saved, saved_narrow


def _drawn(node: Column, rounds: int) -> Column:
    return F.struct(F.xxhash64(node, F.lit(rounds)).alias("at"), node.alias("node"))


def components(edges: DataFrame) -> DataFrame:
    """node, root for every node of the edges (a, b), both long; equal roots mean connected.

    The root is a node of the component, not the smallest. Loops and repeated edges are harmless;
    without edges the result is empty.
    """
    rest = saved(
        edges.where(F.col("a") != F.col("b"))
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(),
        "component-edges",
    )
    n_edges = rest.count()
    most_labels = 2 * n_edges
    labels = saved_narrow(
        rest.select(F.explode(F.array("a", "b")).alias("node")).distinct()
        .withColumn("root", F.col("node")),
        "component-labels", most_labels,
    )
    rounds = 0
    while n_edges:
        sides = rest.select(F.col("a").alias("node"), F.col("b").alias("other")).union(
            rest.select("b", "a")
        )
        first = F.min(_drawn(F.col("other"), rounds)).alias("best")
        best = F.least(F.col("best"), _drawn(F.col("node"), rounds))
        up = saved_narrow(
            sides.groupBy("node").agg(first).select("node", best["node"].alias("parent")),
            "component-parents", 2 * n_edges,
        )
        for _ in range(2):
            further = up.select(F.col("node").alias("parent"), F.col("parent").alias("further"))
            up = saved_narrow(
                up.join(further, "parent").select("node", F.col("further").alias("parent")),
                "component-parents", 2 * n_edges,
            )
        top = [up.select(F.col("node").alias(s), F.col("parent").alias(f"p{s}")) for s in "ab"]
        rest = saved_narrow(
            rest.join(top[0], "a").join(top[1], "b").where(F.col("pa") != F.col("pb"))
            .select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b")).distinct(),
            "component-edges", n_edges,
        )
        labels = saved_narrow(
            labels.join(up.withColumnRenamed("node", "root"), "root", "left")
            .select("node", F.coalesce("parent", "root").alias("root")),
            "component-labels", most_labels,
        )
        n_edges = rest.count()
        rounds += 1
    return labels
