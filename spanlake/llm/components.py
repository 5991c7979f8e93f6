"""Connected components of a table of links, by alternating large-star and small-star steps.

Each step hangs nodes on the smallest neighbour they know; the links shrink to stars in a number of rounds that grows with
the logarithm of the graph's diameter. A step is an aggregation (one row per node and task) and a join on the node, which adaptive
execution splits where one node has very many links. Every round is a table in the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanlake.llm.common import staged


def connected(links: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """(id, component) of every id that has a link to another; the component is its smallest id.

    Null ids and links from an id to itself are ignored.
    """
    pair = [F.greatest(left, right).alias("a"), F.least(left, right).alias("b")]
    edges = links.where(F.col(left).isNotNull() & F.col(right).isNotNull() & (F.col(left) != F.col(right)))
    edges = staged(edges.select(*pair).distinct(), "links")
    state = _state(edges)
    while True:
        edges = staged(_small_star(_large_star(edges)), "links")
        before, state = state, _state(edges)
        if state == before:
            break
    roots = edges.select(F.col("b").alias("id")).distinct()
    return edges.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(
        roots.select("id", F.col("id").alias("component"))
    )


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node hangs its larger neighbours on its smallest one."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node hangs its smaller neighbours, and itself, on the smallest of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()
