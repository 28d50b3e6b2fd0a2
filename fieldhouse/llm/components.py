"""Connected components by alternating large-star and small-star steps, on tables of edges.

A large-star step links every larger neighbour of a node to the smallest node among it and its neighbours; a small-star
step does the same with the node itself and its smaller neighbours. Each step is one aggregation (combined before the
shuffle, so that a node with very many neighbours is no hot spot) and one equi-join, and the edges of each round are
written to the shared folder. The driver sees two numbers per round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldhouse.llm.common import discard, saved


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionAll(edges.select("b", "a"))
    low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.where("v > u").join(low, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    low = edges.groupBy("a").agg(F.min("b").alias("m"))
    onward = edges.join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return onward.unionAll(low.select("a", F.col("m").alias("b"))).distinct()


def components(links: DataFrame, left: str, right: str) -> DataFrame:
    """(node, root) of every node with a link to another: root is the smallest node it is connected with, itself included."""
    edges = links.select(F.greatest(left, right).alias("a"), F.least(left, right).alias("b")).where("a <> b").distinct()
    edges, before = saved(edges, "edges"), None
    while True:
        state = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if state == before or not state[0]:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(
                edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
        before = state
        after = saved(_small_star(_large_star(edges)), "edges")
        discard(edges)
        edges = after
