"""Connected components of a graph of links, by rounds of shuffles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import settle

#: Nodes of more links than this (40 MB of them), and than one in SHARE of all, are hubs: there are 2 * SHARE of them at most, which are broadcast.
HUB, SHARE = 1_000_000, 50_000


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of `links` (a, b): root is the least node that is reachable.

    Alternates two steps until nothing changes: every node hands its least
    neighbour to its greater neighbours, then to its lesser ones, so that
    paths fold into stars in a number of rounds that grows with the logarithm
    of their length. Links with a null end, repeated links and loops count
    for nothing. The links of a hub are not gathered in one task: what it has
    to hand out is broadcast to them.
    """
    edges = settle(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    state = _state(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = _with_least(both, state[0], own=True).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        small = _with_least(large, state[0]).select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("x"))
        edges = settle(small.select("x.a", "x.b").where("a <> b").distinct())
        new = _state(edges)
        if new == state:
            break
        state = new
    roots = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def _with_least(edges: DataFrame, n: int, own: bool = False) -> DataFrame:
    """Each link (a, b) with m, the least b of its a; with `own`, or a itself if that is less. There are about n links."""
    least = F.least("a", F.min("b")) if own else F.min("b")
    known = edges.groupBy("a").agg(least.alias("m"), F.count("*").alias("n"))
    if n <= HUB:  # no node can be a hub
        return edges.join(known.select("a", "m"), "a")
    known, limit = settle(known), max(HUB, n // SHARE)
    hubs = known.where(F.col("n") > limit).select("a", F.col("m").alias("_m"))
    if hubs.isEmpty():
        return edges.join(known.select("a", "m"), "a")
    told = edges.join(F.broadcast(hubs), "a", "left")
    others = told.where("_m is null").select("a", "b").join(known.where(F.col("n") <= limit).select("a", "m"), "a")
    return told.where("_m is not null").select("a", "b", F.col("_m").alias("m")).unionByName(others)


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())
