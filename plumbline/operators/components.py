"""Connected components by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.session import cut_lineage


def connected_components(edges: DataFrame) -> DataFrame:
    """``(id, component)`` for every node of ``edges(a, b)``; the component is its lowest id.

    Each round hangs the neighbours of a node under the lowest of them (Kiveris et
    al., 2014). A node is met only through its minimum, one row per node, so a hub
    never collects its neighbours anywhere. Rounds, each cut by a checkpoint, go
    on until nothing moves.
    """
    current = cut_lineage(edges.where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    state = _fingerprint(current)
    before = None
    while state != before:
        before = state
        current = cut_lineage(_small_star(_large_star(current)))
        state = _fingerprint(current)
    roots = current.select(F.col("b").alias("id"), F.col("b").alias("component"))
    return current.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(roots).distinct()


def _fingerprint(edges: DataFrame) -> tuple:
    r = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
    return r["n"], r["h"]


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
        edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.where("v > u").join(low, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    low = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(low.select("a", F.col("m").alias("b"))).distinct()
