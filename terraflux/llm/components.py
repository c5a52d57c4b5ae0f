"""Connected components by alternating large-star and small-star over an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from terraflux.llm.common import cut


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node's larger neighbours are tied to the least node around it."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node (a > b in each edge) and its smaller neighbours are tied to the least of these."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).distinct()


def _marks(edges: DataFrame) -> Row:
    """Count and two sums of 64-bit hashes: equal for equal sets of edges, and hardly ever for others."""
    return edges.agg(F.count("*"), *[F.sum(F.xxhash64(*key).cast("decimal(20,0)")) for key in (("a", "b"), ("b", "a"))]).first()


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) of each node of edges(a, b); component is the least node reachable.

    Nulls and loops link nothing. Each round writes its edges to the shared folder; it ends when a round of both
    stars changes no edge, so that every node points at its component.
    """
    now = cut(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "cc")
    before = _marks(now)
    while True:
        now = cut(_small_star(_large_star(now)), "cc")
        after = _marks(now)
        if after == before:
            return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(now.select("b", "b").distinct())
        before = after
