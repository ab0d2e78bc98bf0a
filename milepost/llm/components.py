"""Connected components of a link table by alternating stars, all in Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from milepost.llm.common import checkpointed


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star step.  Edges are (a, b) with a > b.

    Every node's smallest neighbour (or itself) becomes the far end of its links
    to larger neighbours (large star) or to itself and the smaller ones (small
    star).  Minima are pre-aggregated, so a node with very many links costs its
    partial sums only; the join back is split by AQE where it is skewed."""
    if large:
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(
            edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        out = both.where("v > u").join(low, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        low = edges.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m"))
        out = edges.join(low, F.col("a") == F.col("u")).select(F.col("b").alias("a"), F.col("m").alias("b")) \
            .union(low.select(F.col("u").alias("a"), F.col("m").alias("b")))
    return out.where("a > b").distinct()


def components(links: DataFrame) -> DataFrame:
    """node, label: the smallest node that each node of ``links`` (a, b: long)
    can reach.  Nodes without links are absent; loops and repeats are harmless."""
    edges = checkpointed(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                         .where("a > b").distinct())

    def state(e):
        x = e.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        return x.n, x.h

    seen = state(edges)
    while seen[0]:
        edges = checkpointed(_star(_star(edges, True), False))
        now = state(edges)
        if now == seen:
            break
        seen = now
    # at the fixed point every link is (node, its component's smallest node)
    return edges.select(F.col("a").alias("node"), F.col("b").alias("label")).union(
        edges.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct())
