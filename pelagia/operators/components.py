"""Connected components of an undirected graph of bounded degree."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from pelagia.runtime import attach, is_small, stage, stage_counting


def connected_components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """``(run, id, root)``: the least id of each node's component.

    ``nodes(run, id)``, ``edges(run, u, v)``. Every round each tree of equal labels is hooked to the least
    label next to it, and labels follow their parents three steps; the rounds end when no tree has a smaller
    neighbour. The labels are written to the shared folder each round, which keeps plans short.
    """
    both = stage(edges.select("run", "u", "v").unionByName(
        edges.select("run", F.col("v").alias("u"), F.col("u").alias("v"))).distinct(), "edges")
    labels, moved = nodes.select("run", "id", F.col("id").alias("root")), 1
    while moved:
        other = labels.select("run", F.col("id").alias("v"), F.col("root").alias("near"))
        beside = both.join(other, ["run", "v"]).groupBy("run", F.col("u").alias("id")).agg(F.min("near").alias("near"))
        trees = (labels.join(beside, ["run", "id"], "left")
                 .groupBy("run", "root").agg(F.min("near").alias("near"))
                 .select("run", "root", F.least("root", "near").alias("parent")))
        if not is_small(labels):
            trees = stage(trees, "trees")
        parent = trees.select("run", F.col("root").alias("parent"), F.col("parent").alias("grand"))
        grand = trees.select("run", F.col("root").alias("grand"), F.col("parent").alias("top"))
        if is_small(labels):
            up = trees.join(F.broadcast(parent), ["run", "parent"]).join(F.broadcast(grand), ["run", "grand"])
            above = labels.join(F.broadcast(up.select("run", "root", "top")), ["run", "root"])
        else:
            up = attach(attach(trees, parent, ["run", "parent"]), grand, ["run", "grand"])
            above = attach(labels, up.select("run", "root", "top"), ["run", "root"])
        labels, moved = stage_counting(above.select("run", "id", F.col("top").alias("root"), F.col("root").alias("was")),
                                       F.col("root") != F.col("was"), "labels")
        labels = labels.drop("was")
    return labels
