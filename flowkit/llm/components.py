"""Connected components of an edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowkit.session import materialize


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Hang every larger neighbour of a node on the least one."""
    around = _both_ways(edges)
    least = around.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return around.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Hang a node and its smaller neighbours on the least of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v")))


def component_roots(edges: DataFrame) -> DataFrame:
    """The least node ``root`` that each node ``node`` of the edges ``u``, ``v`` (longs) can reach.

    Nodes without an edge do not come back. Stars are built in turn over
    larger and smaller neighbours until nothing moves; each round is written
    to the shared folder, so lost executors cost one round at most.
    """
    edges = materialize(edges.where("u <> v").select("u", "v").distinct(), "edges")
    before = None
    while True:
        stars = _small_star(_large_star(edges).distinct()).where("u <> v").distinct()
        edges = materialize(stars, "edges")
        state = edges.agg(
            F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.sum(F.xxhash64("v").cast("decimal(38,0)"))
        ).first()
        if state == before:
            break
        before = state
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)
