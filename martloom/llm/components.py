"""Connected components of an edge list, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.llm.common import staged


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root``, the smallest node it can reach, for every node that is not its own root.

    ``edges`` has long columns a and b; direction, repeats and loops do not
    matter. Every round joins nodes with the least of their neighbours
    (large star: larger neighbours move there; small star: smaller ones), is written to
    the shared folder, and the rounds end when no edge changes: after about the logarithm
    of the longest path. The least neighbour is an aggregate, so hubs combine map-side.
    """
    current = staged(_tidy(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))))
    before = _print(current)
    while True:
        current = staged(_small(_large(current)))
        after = _print(current)
        if after == before:
            return current.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = after


def _tidy(edges: DataFrame) -> DataFrame:
    return edges.where(F.col("a") != F.col("b")).distinct()


def _print(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def _large(edges: DataFrame) -> DataFrame:
    """Each node's larger neighbours get its least neighbour (or itself) as neighbour."""
    least = edges.groupBy("a").agg(F.min("b").alias("least"))
    # the larger neighbours of b are the a of its rows; b's own least neighbour is in ``least`` or b
    moved = edges.join(least.select(F.col("a").alias("b"), "least"), "b", "left")
    return _tidy(moved.select("a", F.coalesce("least", "b").alias("b")))


def _small(edges: DataFrame) -> DataFrame:
    """Each node's smaller neighbours and itself get its least neighbour as neighbour."""
    least = edges.groupBy("a").agg(F.min("b").alias("least"))
    moved = edges.join(least, "a")
    return _tidy(moved.select(F.col("b").alias("a"), F.col("least").alias("b")).union(least.select("a", F.col("least").alias("b"))))
