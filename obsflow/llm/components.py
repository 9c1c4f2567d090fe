"""Connected components of a graph given as links, by alternating large-star
and small-star steps. Each step is a join and an aggregation over links; tables
are written to the shared folder between steps, and only two numbers per step
reach the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import forget, written


def _large_star(links: DataFrame, label: str) -> DataFrame:
    """Every larger neighbour of a node is linked to the least of its
    neighbourhood. The minima are written first, so that both sides of the
    join are plain exchanges and a hub's rows can be split."""
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = written(both.groupBy("a").agg(F.min("b").alias("m")), "components-least")
    near = both.join(least, "a").where("b > a")
    out = written(near.select(F.col("b").alias("a"), F.least("a", "m").alias("b")).distinct(), label)
    forget(least)
    return out


def _small_star(links: DataFrame, label: str) -> DataFrame:
    """Of links from larger to smaller nodes, each node and its smaller
    neighbours are linked to the least of them."""
    least = written(links.groupBy("a").agg(F.min("b").alias("m")), "components-least")
    moved = links.join(least, "a").where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    out = written(moved.union(least.select("a", F.col("m").alias("b"))).distinct(), label)
    forget(least)
    return out


def components(links: DataFrame, label: str = "components") -> DataFrame:
    """``node, component`` for every node of ``links`` (columns ``a, b``, in
    any order); the component is its smallest node. Self links and repeated
    links do no harm; without links the result is empty."""
    oriented = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b").distinct()
    current, before = written(oriented, label), None
    while True:
        state = tuple(current.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b") % 1_000_000_007)).first())
        if state == before or state[0] == 0:
            break
        before, last = state, current
        stars = _large_star(last, label)
        current = _small_star(stars, label)
        forget(last, stars)
    return current.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
