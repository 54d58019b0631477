"""Connected components of a graph kept as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthfold.llm.common import written


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b): the smallest node it is connected to.

    Rounds of contraction: every node takes the smallest of itself and its
    neighbours as parent, and edges become edges between parents. A node with very
    many edges is folded on the map side. Only nodes that are some node's parent go on:
    a small share where ids are in no order along the edges, as digests are, but all
    but one on a path in order of its ids. Tables between rounds are written, so a
    lost executor repeats one round only.
    """
    edges = written(edges.where("a <> b").select("a", "b").distinct(), label)
    roots = None
    while not edges.isEmpty():
        both = edges.select(F.col("a").alias("node"), F.col("b").alias("other")).unionAll(edges.select("b", "a"))
        parents = both.groupBy("node").agg(F.min("other").alias("least"))
        parents = written(parents.select("node", F.least("node", "least").alias("parent")), label)
        if roots is None:
            roots = parents.select("node", F.col("parent").alias("root"))
        else:
            step = parents.select(F.col("node").alias("_n"), "parent")
            roots = roots.join(step, F.col("root") == F.col("_n"), "left").select("node", F.coalesce("parent", "root").alias("root"))
            roots = written(roots, label)
        left = parents.select(F.col("node").alias("a"), F.col("parent").alias("pa"))
        right = parents.select(F.col("node").alias("b"), F.col("parent").alias("pb"))
        moved = edges.join(left, "a").join(right, "b").where("pa <> pb")
        edges = written(moved.select(F.col("pa").alias("a"), F.col("pb").alias("b")).distinct(), label)
    return roots if roots is not None else edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
