"""Connected components of a graph given by edges, by star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import fits, forget, written


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def _contracted(edges: DataFrame) -> DataFrame:
    """All neighbours of a node linked to the smallest of them: first those above the node, then those below."""
    # With few edges their nodes' minima are broadcast, so that a hub's edges stay spread; with many, a skewed join is split by Spark.
    side = F.broadcast if fits(edges) else lambda df: df
    least = lambda df: df.groupBy("u").agg(F.min("v").alias("m"))
    edges = edges.select("u", "v")
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = least(both).select("u", F.least("u", "m").alias("m"))
    above = _ordered(both.join(side(low), "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")))
    low = least(above)
    below = above.join(side(low), "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v")))
    return _ordered(below)


def components(pairs: DataFrame) -> DataFrame:
    """(node, root) of all nodes in pairs (u, v) of long: root is the smallest node that a node is linked with, directly or by others.

    Contractions go on until the edges stay as they are; their number grows with the logarithm of the longest chain. Minima are combined before the
    shuffle, so that a node of very many links is no single task's. No pairs in, no rows out; null and equal pairs and loops count for nothing.
    """
    mark = {"xor": F.bit_xor(F.xxhash64("u", "v"))}
    edges = written(_ordered(pairs), "edges", **mark)
    while edges.stored.rows:
        last, edges = edges, written(_contracted(edges), "edges", **mark)
        forget(last)
        if (edges.stored.rows, edges.stored.found) == (last.stored.rows, last.stored.found):
            break
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
