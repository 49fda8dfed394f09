"""Connected components (distributed union-find by alternating stars) over an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._spark import cut


def _state(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
    return row["n"], row["s"]


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) of `edges` (u, v); component is the smallest node reachable, and a component's own smallest node is not listed.

    Large-star and small-star steps alternate until the edge table no longer changes; each
    step is one map-side combined minimum and one equi-join. In that join a hub has one row on the side of the minima, so
    Spark's adaptive handling of skewed joins deals a large hub's edges to several tasks. Self-loops, repeated edges, nulls and either direction are allowed; nodes that
    only have self-loops are not returned. An empty table gives an empty result.
    """
    edges = edges.where("u is not null and v is not null and u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    edges = cut(edges)
    before = _state(edges)
    if not before[0]:
        return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v")))
        edges = cut(small.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
        now = _state(edges)
        if now == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
        before = now
