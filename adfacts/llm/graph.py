"""Connected components of a graph held as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adfacts.llm.common import Scratch


def connected_components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, component) for every node of an edge; the component is its smallest node.

    ``edges`` holds ``a`` and ``b`` of one ordered type, in either direction, repeats
    allowed. Large-star and small-star steps alternate until the edges no longer change:
    the number of rounds grows with the logarithm of the longest chain. Each round ends in
    a table of ``scratch``, which has to last until the result is used. Minima combine before the shuffle, and the joins that bring them back
    are plain, so adaptive execution can split the part of a node with many edges.
    """
    now = scratch.table(_directed(edges), "components")
    before = None
    while (state := _state(now)) != before:
        before = state
        now = scratch.table(_small_star(_large_star(now)), "components")
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )


def _directed(edges: DataFrame) -> DataFrame:
    """Each edge once, from the larger node to the smaller."""
    return (
        edges.where(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )


def _state(edges: DataFrame) -> tuple:
    checks = [F.sum(F.xxhash64("a", "b", F.lit(i)) % 2**40).alias(f"s{i}") for i in (1, 2)]
    return tuple(edges.agg(F.count("*"), *checks).first())


def _large_star(edges: DataFrame) -> DataFrame:
    """Larger neighbours of a node are linked to its smallest neighbour (itself included)."""
    both = edges.union(edges.select("b", "a"))
    least = both.groupBy("a").agg(F.min("b").alias("least"))
    least = least.select("a", F.least("a", "least").alias("least"))
    return (
        both.join(least, "a")
        .where(F.col("b") > F.col("a"))
        .select(F.col("b").alias("a"), F.col("least").alias("b"))
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them."""
    directed = _directed(edges)
    least = directed.groupBy("a").agg(F.min("b").alias("least"))
    moved = directed.join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return _directed(moved.union(least.select("a", F.col("least").alias("b"))))
