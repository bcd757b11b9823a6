"""Connected components of an edge list, as Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spark_triples.session import stage


def _state(edges: DataFrame) -> tuple:
    return tuple(
        edges.agg(
            F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).first()
    )


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node moves to the node's smallest neighbour (or itself)."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"))
    least = least.select("node", F.least("m", "node").alias("m"))
    joined = both.join(least, F.col("a") == F.col("node"))
    moved = joined.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.filter("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours move to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"))
    joined = down.join(least, F.col("a") == F.col("node"))
    moved = joined.select(F.col("b").alias("a"), F.col("m").alias("b"))
    moved = moved.unionByName(least.select(F.col("node").alias("a"), F.col("m").alias("b")))
    return moved.filter("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(a, b): every node that is not the smallest of its component, and that smallest one.

    ``edges`` has the long columns a and b. Large-star and small-star steps alternate until
    the edges stand still; they are stars then. The number of rounds grows with the logarithm
    of the longest path. Neighbours are never gathered: minima are aggregated before the
    shuffle, and a node with very many edges is split by the skew join.
    """
    now = stage(edges.select("a", "b").filter("a <> b").distinct(), "edges")
    state = _state(now)
    while state[0]:
        now = stage(_small_star(_large_star(now)), "edges")
        before, state = state, _state(now)
        if state == before:
            break
    return now
