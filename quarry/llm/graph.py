"""Distributed connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm import common


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """(node, component) for all nodes of undirected `edges` (a, b: long); component is the smallest node reachable.

    Each round sends every node's larger neighbours to its smallest one, then every node's smaller neighbours; the
    rounds end when no edge changes, with a star around each component's smallest node. Minima are taken before
    the shuffle, and a join on a node with very many edges is split by adaptive execution. Rounds are cut by files in
    the shared folder. Self-loops give isolated nodes; null ends are ignored; no edge gives no row.
    """
    lone = edges.where(F.col("a") == F.col("b")).select(F.col("a").alias("node"), F.col("a").alias("component"))
    stars = common.materialise(
        edges.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct(), label
    )
    while True:
        both = stars.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(stars.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
        # written, so that the join below has a shuffle of its own on either side: adaptive execution splits the edges of a hot node
        least = common.materialise(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), label)
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo"))
        # an edge (u, m) is already among them: u's smallest neighbour m has u as a larger neighbour
        large = large.where("hi <> lo").distinct()
        lower = large.groupBy("hi").agg(F.min("lo").alias("m"))
        moved = large.join(lower, "hi")
        small = moved.select(F.col("lo").alias("hi"), F.col("m").alias("lo")).unionByName(lower.select("hi", F.col("m").alias("lo")))
        new = common.materialise(small.where("hi <> lo").distinct(), label)
        digest = [F.count("*"), F.coalesce(F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)")), F.lit(0))]
        same = new.agg(*digest).first() == stars.agg(*digest).first()
        common.discard(stars)
        common.discard(least)
        stars = new
        if same:
            break
    found = stars.select(F.col("hi").alias("node"), F.col("lo").alias("component"))
    return found.unionByName(stars.select(F.col("lo").alias("node"), F.col("lo").alias("component"))).unionByName(lone).groupBy("node").agg(F.min("component").alias("component"))
