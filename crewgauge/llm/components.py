"""Connected components by alternating large-star and small-star rounds.

Each round points the neighbours of a node at their smallest neighbour, by an aggregation and a join; no node's
neighbours are gathered in one place, so a node with very many of them only makes a large partition, which adaptive
execution splits. The number of rounds grows with the logarithm of the number of nodes. Every round is written to the
shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from crewgauge.llm.scratch import written


#: Edges in a file of a round's result; rounds of few edges leave few files.
FILE_EDGES = 100_000


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _star(neighbours: DataFrame) -> DataFrame:
    """Each neighbour ``b`` of ``a`` with the smallest of ``a`` and its neighbours."""
    least = neighbours.groupBy("a").agg(F.min("b").alias("least")).withColumn("least", F.least("a", "least"))
    return neighbours.join(least, "a")


def _large_star(edges: DataFrame) -> DataFrame:
    rows = _star(_both_ways(edges)).where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return rows.where("a != b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    rows = _star(down)
    moved = rows.select(F.col("b").alias("a"), F.col("least").alias("b"))
    return moved.unionByName(rows.select("a", F.col("least").alias("b"))).where("a != b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable from every node that has an edge. ``edges`` has columns a and b."""
    edges = written(edges.where("a != b").select("a", "b").distinct(), "edges")
    state, many = None, edges.count()
    while True:
        edges = written(_small_star(_large_star(edges)).coalesce(1 + many // FILE_EDGES), "edges")
        now = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x"), F.sum(F.xxhash64("b", "a") % 1_000_003).alias("s")).first()
        if now == state:
            break
        state, many = now, now["n"]
    pairs = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return pairs.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct()
