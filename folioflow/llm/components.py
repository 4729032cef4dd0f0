"""Connected components of an edge table by alternating star operations.

Large star: every neighbour above a node is linked to the node's least neighbour. Small
star: a node and its lower neighbours are linked to the least of them. Both keep the
components; alternating them ends, after a number of rounds that grows with the logarithm
of the number of nodes, in stars around the least nodes. No task sees more than its share
of a hub's edges: minima combine before the shuffle and the joins can be split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioflow.llm.store import materialise


def components(edges: DataFrame, name: str) -> DataFrame:
    """(node, root) of every node of ``edges`` (a long, b long); root is the least node reachable."""
    now = materialise(_ordered(edges), f"{name}-edges")
    before = None
    while (state := _state(now)) != before and state[0]:
        before = state
        now = materialise(_small_star(_large_star(now)), f"{name}-star")
    roots = now.select("b").distinct().select(F.col("b").alias("node"), F.col("b").alias("root"))
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)


def _ordered(edges: DataFrame) -> DataFrame:
    """Distinct edges from the greater to the smaller node."""
    return edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return _ordered(both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                    .union(least.select("a", F.col("m").alias("b"))))


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    return _ordered(edges.join(least, "a").select("b", F.col("m").alias("a")).select("a", "b").union(least.select("a", F.col("m").alias("b"))))


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
    return row.n, row.h
