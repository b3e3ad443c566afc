"""Connected components of an edge table by alternating star contractions, all in joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import stage


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _contract(links: DataFrame, larger: bool) -> DataFrame:
    """Link the neighbours of each node (those above it, or the node and those below it) to the least of them."""
    near = links if larger else links.where("b < a")
    least = near.groupBy("a").agg(F.min("b").alias("m"))
    least = least.withColumn("m", F.least("a", "m"))
    joined = near.join(least, "a")
    if larger:
        moved = joined.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        moved = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            least.select("a", F.col("m").alias("b"))
        )
    return moved.where("a != b").distinct()


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node with an edge; root is the least node of its component.

    Self-edges and repeated edges are harmless. Each round is written out, so a lost executor costs one round.
    """
    links = edges.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a != b").distinct()
    links = stage(links, "edges")
    before = None
    while True:
        links = stage(_contract(_both_ways(_contract(_both_ways(links), True)), False), "edges")
        now = tuple(links.agg(F.count("*"), F.coalesce(F.bit_xor(F.xxhash64("a", "b")), F.lit(0))).first())
        if now == before or now[0] == 0:
            break
        before = now
    # every remaining edge leads from a node to its root
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
