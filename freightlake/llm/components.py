"""Connected components of a table of edges, by large and small stars.

Each round joins every node with the least of its neighbours and itself: the
large-star step moves a node's greater neighbours to that least node, the
small-star step its smaller ones.  Both keep components and end, after a number
of rounds that grows with the logarithm of the longest path, with one star for
each component.  Rounds are written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freightlake.llm.common import if_small, stage


def _round(edges: DataFrame, count: int) -> DataFrame:
    """A large-star and a small-star step."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    large = both.where("v > u").join(if_small(least, 2 * count), "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    large = large.where("u <> v")  # u is the greater end of every edge now
    least = large.groupBy("u").agg(F.min("v").alias("m"))
    moved = large.join(if_small(least, count), "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()


def labels(edges: DataFrame, a: str, b: str, hops: int = 3) -> DataFrame:
    """(node, component): the least node that so many hops reach.  Nodes with
    equal labels are connected; connected nodes may have different ones."""
    n = edges.count()
    both = edges.select(F.col(a).alias("node"), F.col(b).alias("v")).union(edges.select(b, a))
    found = both.groupBy("node").agg(F.least(F.min("v"), F.col("node")).alias("component"))
    for _ in range(hops - 1):
        step = found.withColumnRenamed("node", "v")
        found = both.join(if_small(step, 2 * n), "v").groupBy("node").agg(F.min("component").alias("component"))
    return found


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component) for every node of an edge between two different nodes;
    component is the least node.  NULL ends are no nodes."""
    now = stage(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where(F.col(a) != F.col(b)).distinct(), "edges")
    before, mark = None, _fingerprint(now)
    while mark != before:
        now = stage(_round(now, mark[0]), "star")
        before, mark = mark, _fingerprint(now)
    nodes = now.select(F.col("u").alias("node"), F.col("v").alias("component"))  # stars: each node has one edge down
    return nodes.unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def _fingerprint(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())
