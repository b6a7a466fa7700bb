"""Connected components by breadth-first search from many seeds at once.

Adjacency lists are hash-partitioned. Every node whose hash is below those of all its
neighbours is a seed; all seeds expand their frontiers together, one hop a round, and a node
takes the smallest label that reaches it first. Where the regions of two seeds touch, the
seeds collide: the collisions make a graph of at most half as many nodes, which is treated
alike until none are left. No list of links or nodes comes to the driver, and a node with a
third of all links is one key of a join whose rows the engine may split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import settle


def _order(c: str):
    """Hash order of nodes, ties of the hash broken by the node itself."""
    return F.struct(F.xxhash64(c).alias("h"), F.col(c).alias("node"))


def components(links: DataFrame) -> DataFrame:
    """(node, root): for every node of links (a, b), one node of its component, the same for all.

    Links with a NULL end are left out; a link of a node with itself makes a component of one.
    """
    ok = links.filter(F.col("a").isNotNull() & F.col("b").isNotNull())
    edges = settle(ok.select(F.col("a").alias("src"), F.col("b").alias("dst")).union(ok.select("b", "a")).distinct())
    reach = edges.groupBy("src").agg(F.min(_order("dst")).alias("least")).select("src", (_order("src") <= F.col("least")).alias("seed"))
    seen = settle(reach.filter("seed").select(F.col("src").alias("node"), F.col("src").alias("root")))
    front = seen
    while not front.isEmpty():
        hop = edges.join(front, F.col("src") == F.col("node")).select(F.col("dst").alias("node"), "root").groupBy("node").agg(F.min(_order("root")).alias("r"))
        front = settle(hop.join(seen.select("node"), "node", "left_anti").select("node", F.col("r.node").alias("root")))
        seen = seen.union(front)
    seen = settle(seen)
    ends = [seen.select(F.col("node").alias(x), F.col("root").alias(f"{x}_root")) for x in ("src", "dst")]
    touch = edges.filter(F.col("src") < F.col("dst")).join(ends[0], "src").join(ends[1], "dst").filter("src_root <> dst_root").select(F.col("src_root").alias("a"), F.col("dst_root").alias("b"))
    touch = settle(touch.distinct())
    if touch.isEmpty():
        return seen
    merged = components(touch).select(F.col("node").alias("root"), F.col("root").alias("top"))
    return seen.join(merged, "root", "left").select("node", F.coalesce("top", "root").alias("root"))
