"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import Scratch


def _star(arcs: DataFrame) -> DataFrame:
    """Each node's smallest neighbour, itself included, joined to its arcs."""
    least = arcs.groupBy("u").agg(F.min("v").alias("w")).select("u", F.least("u", "w").alias("m"))
    return arcs.join(least, "u")


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, root) for each node that has an edge (u, v); root is the smallest node of its component.

    Alternating large-star and small-star steps: a step is a minimum per node, reduced before the shuffle, and a join
    on the node; the arcs never outnumber the edges, so a hub costs its degree. Each round is written to the shared
    folder, and the rounds end when the arcs no longer change.
    """
    arcs = scratch.table(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "arcs")
    before = None
    while True:
        # Two independent sums of the arcs tell whether a round changed them.
        now = arcs.agg(F.count("*"), F.sum(F.hash("u", "v").cast("decimal(38,0)")), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            return arcs.select(F.col("u").alias("node"), F.col("v").alias("root")).union(arcs.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()
        before = now
        both = arcs.union(arcs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _star(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        small = _star(down).select(F.explode(F.array(F.struct("v", "m"), F.struct(F.col("u").alias("v"), "m"))).alias("a"))
        arcs = scratch.table(small.select(F.col("a.v").alias("u"), F.col("a.m").alias("v")).where("u <> v").distinct(), "arcs")
