"""Connected components of an edge table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orrery.llm.common import materialize


def _both(edges: DataFrame) -> DataFrame:
    return edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node with the least of the node and its neighbours."""
    n = _both(edges)
    least = n.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return n.filter("v > u").join(least, "u").select(F.col("m").alias("a"), F.col("v").alias("b")).filter("a != b")


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours with the least of them."""
    n = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    least = n.groupBy("u").agg(F.min("v").alias("m"))
    r = n.join(least, "u")
    return (r.select(F.col("m").alias("a"), F.col("v").alias("b")).unionByName(r.select(F.col("m").alias("a"), F.col("u").alias("b")))
             .filter("a != b").distinct())


def _is_stars(edges: DataFrame) -> bool:
    """Whether every larger end has one edge and is no smaller end."""
    ends = edges.select(F.col("b").alias("n"), F.lit(1).alias("up"), F.lit(0).alias("hub")).unionByName(
        edges.select(F.col("a").alias("n"), F.lit(0).alias("up"), F.lit(1).alias("hub")))
    return ends.groupBy("n").agg(F.sum("up").alias("up"), F.max("hub").alias("hub")).filter("up + hub > 1").isEmpty()


def components(edges: DataFrame, rounds: int | None = None) -> DataFrame:
    """(node, component) for every node of the edges (a, b); the component is its least node.

    Each round is two grouped minima and joins (hubs are pre-aggregated, their join sides
    may be split) and is written as a table; the number of rounds is logarithmic in
    practice. With ``rounds`` no more than these are made: nodes with one component are
    then connected, but connected nodes may have several. Self loops are dropped.
    """
    e, done = materialize(edges.filter("a != b").distinct(), "edges"), 0
    while (rounds is None or done < rounds) and not (rounds is None and _is_stars(e)):
        e, done = materialize(_small_star(_large_star(e)), "edges"), done + 1
    ends = e.select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("component"))
    ends = ends.unionByName(e.select(F.least("a", "b").alias("node"), F.least("a", "b").alias("component")))
    return ends.groupBy("node").agg(F.min("component").alias("component"))
