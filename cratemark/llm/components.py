"""Connected components of links, by joins and grouped minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cratemark.llm.storage import discard, stored


def components(links: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``links`` (columns a and b): the smallest
    node that can be reached. Nulls link nothing; loops and repeats are allowed.

    Large-star and small-star steps in turn, until no link changes: every node
    hands its larger neighbours, then its smaller ones, to the least of them. The
    number of links does not grow, and the number of rounds goes with the
    logarithm of the longest chain. The least neighbour is found by a grouped
    minimum, which is combined before the shuffle, and handed out by a join,
    where adaptive execution splits a node of very many links.
    """
    edges = _directed(links.select("a", "b").where(F.col("a") != F.col("b")))
    edges = stored(edges, "component-links")
    state, superseded = None, []
    while (now := _state(edges)) != state:
        state = now
        superseded.append(edges)
        edges = stored(_small_star(_large_star(edges)), "component-links")
    for old in superseded:
        discard(old)
    roots = edges.select(F.col("small").alias("node")).distinct()
    return edges.select(F.col("big").alias("node"), F.col("small").alias("root")).unionByName(
        roots.select("node", F.col("node").alias("root"))
    )


def _state(edges: DataFrame) -> tuple:
    """Two numbers that tell whether a round changed any link."""
    mixed = F.xxhash64("big", "small") % (1 << 32)
    return tuple(edges.agg(F.count("*"), F.sum(mixed)).first())


def _directed(links: DataFrame) -> DataFrame:
    return links.select(
        F.greatest("a", "b").alias("big"), F.least("a", "b").alias("small")
    ).distinct()


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's least, which may
    be the node itself."""
    both = edges.select(F.col("big").alias("node"), F.col("small").alias("other")).unionByName(
        edges.select(F.col("small").alias("node"), F.col("big").alias("other"))
    )
    least = both.groupBy("node").agg(F.least(F.min("other"), F.col("node")).alias("least"))
    # A larger neighbour sees the node as its smaller end.
    return _directed(
        edges.join(least, edges["small"] == least["node"]).select(
            F.col("big").alias("a"), F.col("least").alias("b")
        )
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """The smaller neighbours of a node, and the node itself, are linked to the
    least of them."""
    least = edges.groupBy("big").agg(F.min("small").alias("least"))
    joined = edges.join(least.withColumnRenamed("big", "node"), F.col("big") == F.col("node"))
    return _directed(
        joined.where(F.col("small") != F.col("least"))
        .select(F.col("small").alias("a"), F.col("least").alias("b"))
        .unionByName(least.select(F.col("big").alias("a"), F.col("least").alias("b")))
    )
