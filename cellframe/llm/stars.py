"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cellframe.session import write_through


def _mark(edges: DataFrame) -> tuple:
    """Tells whether two edge tables are equal, without moving them."""
    return tuple(edges.agg(F.count("*"), F.sum(F.shiftright(F.xxhash64("u", "v"), 20)),
                           F.bit_xor(F.xxhash64("v", "u"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, label) of every node in `edges(u, v)`; the label is the smallest node it can reach.

    Minima are written before they are joined to the edges, so that adaptive planning sees two plain
    exchanges and can split a node with very many neighbours. Every step reads written tables only.
    """
    edges = write_through(
        edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    mark = _mark(edges)
    while mark[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = write_through(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "least")
        large = write_through(
            both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "large")
        least = write_through(large.groupBy("u").agg(F.min("v").alias("m")), "least")
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = write_through(
            small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "small")
        before, mark = mark, _mark(edges)
        if before == mark:
            break
    ends = edges.select(F.col("u").alias("node"), F.col("v").alias("label"))
    return ends.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("label"))).distinct()
