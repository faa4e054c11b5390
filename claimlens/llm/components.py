"""Connected components of links, by alternating large and small stars.

Each round links every node's greater neighbours to its least one, then the rest likewise; the number of rounds grows
with the logarithm of a component's size. A round ends in a written table, so lost executors cost one round at most.
A node with very many links stays splittable: a round aggregates by node, combined before the shuffle, and joins the
result back on the node and a hash of it, so that both sides are shuffled for the join and AQE may split a node's links.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimlens.llm.common import stored


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """edges (a < b). Large: each node's greater neighbours point to the least of it and its neighbours; small: its lesser ones do."""
    if large:
        near = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    else:
        near = edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
    least = near.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    own = least.withColumnRenamed("u", "least_of")
    met = near.join(own, (F.col("u") == F.col("least_of")) & (F.xxhash64("u") == F.xxhash64("least_of")))
    if large:
        return met.where("v > u").select(F.col("m").alias("a"), F.col("v").alias("b")).where("a < b").distinct()
    out = met.where("v > m").select(F.col("m").alias("a"), F.col("v").alias("b"))
    return out.union(least.select(F.col("m").alias("a"), F.col("u").alias("b"))).where("a < b").distinct()


def components(links: DataFrame) -> DataFrame:
    """Every node of links (a, b) with the least node of its component: (node, root)."""
    edges = stored(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b"), "links")
    while True:
        new = stored(_star(_star(edges, True), False), "stars")
        # Done when all edges are stars: no centre is a leaf, no leaf has two centres.
        total = new.agg(F.count("*").alias("n"), F.countDistinct("b").alias("leaves")).first()
        if total.n == total.leaves and new.join(new.select(F.col("a").alias("b")).distinct(), "b", "left_semi").isEmpty():
            break
        edges = new
    return new.select(F.col("b").alias("node"), F.col("a").alias("root")).union(new.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct())
