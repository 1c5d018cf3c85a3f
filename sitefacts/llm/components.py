"""Distributed union-find over DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitefacts.plans.scratch import staged


def connected(edges: DataFrame, name: str) -> DataFrame:
    """``(node, root)`` for all nodes of ``edges (a, b)``; the root is the smallest node of its component.

    In each round every node hooks on to its smallest neighbour, if that is smaller, and follows one more pointer; the
    edges between the parents are the next, smaller graph. Nodes should be numbered at random (by a hash): then a
    constant share of them goes in each round even on long paths. A node with very many neighbours is reduced by
    partial aggregation, and joins meet one row of the parents for each node.
    """
    kind = edges.schema["a"].dataType.simpleString()
    left = staged(edges.where("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), f"{name}-edges")
    levels: list[DataFrame] = []
    while not left.isEmpty():
        both = left.union(left.select("b", "a"))
        lowest = both.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("p")).select("u", F.least("u", "p").alias("p"))
        above = lowest.select(F.col("u").alias("p"), F.col("p").alias("pp"))
        parents = staged(lowest.join(above, "p").select("u", F.col("pp").alias("p")), f"{name}-parents")
        levels.append(parents)
        of_a = parents.select(F.col("u").alias("a"), F.col("p").alias("pa"))
        of_b = parents.select(F.col("u").alias("b"), F.col("p").alias("pb"))
        moved = left.join(of_a, "a").join(of_b, "b").where("pa != pb")
        left = staged(moved.select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b")).distinct(), f"{name}-edges")
    if not levels:
        return edges.sparkSession.createDataFrame([], f"node {kind}, root {kind}")
    roots = levels[0].select(F.col("u").alias("node"), F.col("p").alias("root"))
    for parents in levels[1:]:
        roots = roots.join(parents.select(F.col("u").alias("root"), "p"), "root", "left").select("node", F.coalesce("p", "root").alias("root"))
    return staged(roots, f"{name}-roots")
