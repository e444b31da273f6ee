"""Connected components of a link table by two-phase star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..session import discard, materialise
from .skew import join_skewed

# The published bound is O(log^2 n) rounds; passing the guard is an error, since
# stopping early would return components that are still in pieces.
MAX_ROUNDS = 60


def _smallest(edges: DataFrame, node: str, other: str) -> DataFrame:
    return edges.groupBy("scope", F.col(node).alias("u")).agg(F.min(other).alias("m"))


def _large_star(edges: DataFrame, rows: int) -> DataFrame:
    """Link every larger neighbour of a node to the node's smallest neighbour."""
    both = edges.select("scope", F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(
        edges.select("scope", F.col("lo").alias("u"), F.col("hi").alias("v"))
    )
    best = _smallest(both, "u", "v").withColumn("m", F.least("u", "m"))
    upward = edges.select("scope", F.col("lo").alias("u"), F.col("hi").alias("v"))
    return join_skewed(upward, best, ["scope", "u"], rows).select(
        "scope", F.col("v").alias("hi"), F.col("m").alias("lo")
    )


def _small_star(edges: DataFrame, rows: int) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of them."""
    best = _smallest(edges, "hi", "lo")
    moved = join_skewed(edges.withColumnRenamed("hi", "u"), best, ["scope", "u"], rows).where("lo <> m")
    return moved.select("scope", F.col("lo").alias("hi"), F.col("m").alias("lo")).unionByName(
        best.select("scope", F.col("u").alias("hi"), F.col("m").alias("lo"))
    )


def clusters(links: DataFrame) -> DataFrame:
    """(scope, a, b) -> (scope, id, cluster_id) for every linked story.

    ``cluster_id`` is the smallest id of the component. Each round is written out,
    so a lost executor repeats one round at most.
    """
    edges = materialise(
        links.select("scope", F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo"))
        .where("hi <> lo").distinct(),
        "edges",
    )
    mark = F.struct(F.count("*"), F.bit_xor(F.xxhash64("scope", "hi", "lo")))
    before = edges.select(mark).first()[0]
    for _ in range(MAX_ROUNDS):
        rows = before[0]
        moved = materialise(_small_star(_large_star(edges, rows).distinct(), rows).distinct(), "edges")
        discard(edges)
        edges = moved
        after = edges.select(mark).first()[0]
        if after == before:
            members = edges.select("scope", F.col("hi").alias("id"), F.col("lo").alias("cluster_id"))
            roots = edges.select("scope", F.col("lo").alias("id"), F.col("lo").alias("cluster_id")).distinct()
            return members.unionByName(roots)
        before = after
    raise RuntimeError(f"components did not settle within {MAX_ROUNDS} rounds")
