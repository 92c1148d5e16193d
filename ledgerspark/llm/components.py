"""Connected components of a graph by large and small stars, on tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerspark.operators.quality import own_exchange
from ledgerspark.session import materialize


def _neighbours(edges: DataFrame) -> DataFrame:
    return edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
        edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
    )


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node's larger neighbours are tied to its smallest one (or itself)."""
    around = _neighbours(edges)
    least = around.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return around.where("v > u").join(own_exchange(least), "u").select(F.col("v").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours are tied to the smallest of these."""
    down = edges.where("a > b").select(F.col("a").alias("u"), F.col("b").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    tied = down.join(own_exchange(least), "u")
    return (
        tied.where("v > m").select(F.col("v").alias("a"), F.col("m").alias("b"))
        .unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    )


def components(edges: DataFrame, rounds: int = 50) -> DataFrame:
    """node, root (smallest node of the component) for all nodes but the roots.

    ``edges``: columns a, b, comparable, any order. Each round is written out, so lineage
    stays short; two numbers per round tell the driver whether anything changed. A node with
    many neighbours is reduced to its smallest one on the map side; the join that ties its
    neighbours is split by adaptive execution, as the least ones have an exchange of their own.
    """
    edges = materialize(
        edges.where("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        "edges",
    )
    mark = None
    for _ in range(rounds):
        edges = materialize(_small_star(_large_star(edges)).distinct(), "edges")
        seen = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(seen) == mark:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        mark = tuple(seen)
    raise RuntimeError(f"No end after {rounds} rounds.")
