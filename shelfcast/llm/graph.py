"""Connected components of an edge list, by alternating large-star and small-star steps (Kiveris et al., 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.shared import materialise


def _towards_least(pairs: DataFrame) -> DataFrame:
    """For each (u, v) the least of u and all its v: (u, v, least)."""
    least = pairs.groupBy("u").agg(F.min("v").alias("least")).select("u", F.least("u", "least").alias("least"))
    return pairs.join(least, "u")


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of the edges (a, b); the component is its least node.

    Each step groups edges by node with a partial minimum and joins it back, so no node's edges meet in one task
    unless Spark can split them; the number of steps grows with the logarithm of the longest path.  Edges are written
    to the shared folder between steps.  Self-loops and repeated edges do no harm; no edges give no rows.
    """
    now = materialise(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    state = None
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _towards_least(both).where("v > u and v <> least").select(F.col("v").alias("u"), F.col("least").alias("v")).distinct()
        stars = _towards_least(large)
        small = stars.where("v <> least").select(F.col("v").alias("u"), F.col("least").alias("v")).unionByName(stars.select("u", F.col("least").alias("v"))).where("u <> v").distinct()
        now = materialise(small)
        found = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if found == state:
            break
        state = found
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
