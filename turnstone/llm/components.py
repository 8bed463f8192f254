"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch


def _least(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """For each node of edges (node, other), the least of itself and its others."""
    least = edges.groupBy("node").agg(F.min("other").alias("least"))
    return scratch.keep(least.select("node", F.least("node", "least").alias("least")), "least")


def connected_components(edges: DataFrame, scratch: Scratch, max_rounds: int = 60) -> DataFrame:
    """(node, component): the smallest node reachable, for nodes that have an edge.

    *edges* has the long columns ``a`` and ``b``; direction, repeated rows and
    loops do not matter, rows with a null end are ignored, and an empty table
    gives an empty result.

    Alternating large-star and small-star steps hook every node to the least
    node known near it.  Each step is a min-aggregate, combined before its
    shuffle, and a plain join that adaptive execution can split when a hub
    node is hot; nothing is gathered per node or on the driver but one
    checksum of a round.  Rounds grow with the logarithm of the longest path.
    """
    tree = edges.where("a is not null and b is not null and a <> b")
    tree = scratch.keep(tree.select(F.greatest("a", "b").alias("child"), F.least("a", "b").alias("parent")).distinct(), "tree")
    before = None
    for _ in range(max_rounds):
        both = tree.select(F.col("child").alias("node"), F.col("parent").alias("other")).unionByName(tree.select(F.col("parent").alias("node"), F.col("child").alias("other")))
        large = both.join(_least(both, scratch), "node").where("other > node").select(F.col("other").alias("child"), F.col("least").alias("parent"))
        tree = scratch.keep(large.where("child <> parent").distinct(), "large")
        down = tree.select(F.col("child").alias("node"), F.col("parent").alias("other"))
        small = down.join(_least(down, scratch), "node").select(F.explode(F.array("node", "other")).alias("child"), F.col("least").alias("parent"))
        tree = scratch.keep(small.where("child <> parent").distinct(), "small")
        now = tree.agg(F.count("*"), F.sum(F.xxhash64("child", "parent").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("components did not settle")
    roots = tree.select(F.col("parent").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return tree.select(F.col("child").alias("node"), F.col("parent").alias("component")).unionByName(roots)
