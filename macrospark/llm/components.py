"""Connected components of a distributed edge list, by alternating star contractions.

Each round points every node's larger neighbours at its smallest one, then every node's smaller
neighbours; edges never grow in number, and the forest of stars is reached after a few rounds.
Every grouping is a minimum, combined before its shuffle, so a node with a third of all edges
costs one row per task; joins on such a node are split by adaptive execution. Each round is
written to the shared folder, so a lost executor costs one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from macrospark.llm.common import written


def _signature(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v") % F.lit(1 << 40)).alias("h")).first()
    return row["n"], row["h"] or 0


def _pointed(pairs: DataFrame, smallest: DataFrame, keep) -> DataFrame:
    """Neighbours `v` of each `u` that pass `keep`, pointed at the smallest node around `u`."""
    return pairs.join(smallest, "u").where(keep).select(F.col("v").alias("u"), F.col("low").alias("v"))


def _least(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("low"))


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) for each node with an edge, where root is the smallest node of its component.

    Edges with a null end and edges from a node to itself say nothing and are left out; no
    edges give an empty result.
    """
    u, v = F.col(a), F.col(b)
    current = written(
        edges.where(u != v).select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v")).distinct(), "components"
    )
    seen = _signature(current)
    while seen[0]:
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _pointed(both, _least(both), F.col("v") > F.col("u")).distinct()
        small_least = large.groupBy("u").agg(F.min("v").alias("low"))
        small = (
            _pointed(large, small_least, F.col("v") != F.col("low"))
            .unionByName(small_least.select("u", F.col("low").alias("v")))
            .distinct()
        )
        current = written(small, "components")
        now = _signature(current)
        if now == seen:
            break
        seen = now
    return current.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        current.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
