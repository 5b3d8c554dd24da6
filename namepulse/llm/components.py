"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .shared import hot_join, kept


def _normal(edges: DataFrame) -> DataFrame:
    """(a, b) with a > b, each edge once."""
    hi, lo = F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    return edges.where("a <> b").select(hi, lo).distinct()


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the smallest node next to it, itself included."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("least"))
    # Only larger neighbours move: those rows of `both` that are reversed edges.
    larger = edges.select(F.col("b").alias("a"), F.col("a").alias("b"))
    return hot_join(larger, least, ["a"]).select(F.col("b").alias("a"), F.col("least").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("least"))
    moved = hot_join(edges, least, ["a"]).select(F.col("b").alias("a"), F.col("least").alias("b"))
    return moved.union(least.select("a", F.col("least").alias("b")))


def _mark() -> list[Column]:
    """Columns that tell one set of edges from another."""
    h = F.xxhash64("a", "b")
    return [F.count("*"), F.expr("bit_xor(xxhash64(a, b))"), F.sum(h.bitwiseAND(F.lit(0xFFFFFFFF)))]


def components(edges: DataFrame, rows: int | None = None) -> DataFrame:
    """(node, root) for every node of edges (a, b): root is the component's smallest node.

    Alternates large-star and small-star steps until nothing changes, which takes a number of
    rounds logarithmic in the nodes. Every round is a table in the shared folder, so that lost
    executors cost one round at most. A node of any degree is split over tasks. Self-loops and
    repeated edges do not matter; no edges give no rows. `rows`: about how many edges there
    may be, for the number of files of the first table; a round never adds edges.
    """
    now = kept(_normal(edges), "edges", rows)
    mark = tuple(now.agg(*_mark()).first())
    while mark[0]:
        after = kept(_normal(_small_star(_normal(_large_star(now)))), "edges", mark[0])
        now, before, mark = after, mark, tuple(after.agg(*_mark()).first())
        if mark == before:
            break
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
