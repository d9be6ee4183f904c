"""Connected components of a graph given by its links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirelens.llm.base import Scratch


def _toward_least(edges: DataFrame, both_ways: bool) -> DataFrame:
    """Tie every neighbour of a node to the least of them.

    `edges` are (u, v) with u > v. With `both_ways` a node ties its larger neighbours (large star),
    else its smaller ones and itself (small star). Hot nodes are no hindrance: minima combine before the
    shuffle, and the join has one row per node on its other side.
    """
    near = edges.select(F.col("u").alias("x"), F.col("v").alias("y"))
    if both_ways:
        near = near.union(edges.select("v", "u"))
    least = near.groupBy("x").agg(F.min("y").alias("m"))
    if both_ways:
        least = least.select("x", F.least("x", "m").alias("m"))
        tied = near.filter(F.col("y") > F.col("x")).join(least, "x").select(F.col("y").alias("u"), F.col("m").alias("v"))
    else:
        tied = near.join(least, "x").filter(F.col("y") != F.col("m")).select(
            F.col("y").alias("u"), F.col("m").alias("v")).union(least.select("x", "m"))
    return tied.distinct()


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """`node` and `root`, the least node it is connected to, for every node of `links` (a, b) but the roots.

    Large and small stars take turns (Kiveris et al., 2014) until nothing changes. Every round is written,
    so a lost executor costs one round at most.
    """
    start = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u > v").distinct()
    edges, state, turn = scratch.keep(start, "star-0"), None, 0
    while True:
        now = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if now == state or not now[0]:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        state, turn = now, turn + 1
        edges = scratch.keep(_toward_least(_toward_least(edges, True), False), f"star-{turn}")
        scratch.drop(f"star-{turn - 1}")
