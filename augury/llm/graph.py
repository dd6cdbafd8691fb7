"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from augury.session import freeze


def components(links: DataFrame, most_rounds: int = 100) -> DataFrame:
    """Links (a, b) to (node, component): the smallest node that each node reaches.

    Large-star and small-star steps in turn: every node's larger neighbours, then its smaller
    ones, are linked with its smallest neighbour, until nothing changes. The number of links
    never grows, and the rounds follow the logarithm of a component's size. Each round is
    checkpointed. A node with many links only meets them as counted-up minima and in joins
    whose hot keys Spark splits.
    """

    def both(edges: DataFrame) -> DataFrame:
        return edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))

    def least(edges: DataFrame) -> DataFrame:
        return edges.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))

    edges = freeze(links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    for _ in range(most_rounds):
        sym = both(edges)
        large = sym.join(least(sym), "a").filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = freeze(large.filter("a <> b").distinct())
        small = large.join(least(large), "a").select(F.explode(F.array(F.col("a"), F.col("b"))).alias("a"), F.col("m").alias("b"))
        small = freeze(small.filter("a <> b").distinct())
        changed = small.join(edges, ["a", "b"], "left_anti").union(edges.join(small, ["a", "b"], "left_anti"))
        edges = small
        if changed.isEmpty():
            break
    else:
        raise RuntimeError("components did not settle")
    roots = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return roots.union(edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
