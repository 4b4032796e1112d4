"""Connected components of a link table by alternating large-star and small-star rounds (Kiveris et al., 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandwise.llm.common import written
from strandwise.scratch import dropped


def _star(links: DataFrame, both: DataFrame, larger: bool) -> DataFrame:
    """Each node's minimum meets its links by a join that Spark can split, so a node with very many links is no single task."""
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    near = both.join(least, "u").filter(F.col("v") > F.col("u") if larger else F.col("v") < F.col("u"))
    out = near.select(F.col("v").alias("u"), F.col("m").alias("v"))
    if not larger:
        out = out.unionByName(near.select("u", F.col("m").alias("v")))
    return out.filter(F.col("u") != F.col("v")).distinct()


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, root) for every node of links (u, v): root is the smallest node reachable. Longs, no nulls; empty gives empty."""
    edges = written(links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v").distinct(), "links")
    seen = None
    for _ in range(rounds):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _star(edges, both, True)
        before, edges = edges, written(_star(large, large, False), "stars")
        dropped(before)
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen = state
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    # Every edge now runs from a node to its root.
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
