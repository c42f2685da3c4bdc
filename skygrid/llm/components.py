"""Connected components of an edge table by alternating stars; every round is written to the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skygrid.llm.common import written


def _star(edges: DataFrame, small: bool) -> DataFrame:
    """Each node's neighbours (the smaller ones, or the larger ones) are linked to the smallest of the neighbourhood."""
    if small:
        around = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    else:
        around = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    low = around.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    met = around.join(low, "u")
    if small:
        out = met.select(F.col("v").alias("a"), F.col("m").alias("b")).union(low.select(F.col("u").alias("a"), F.col("m").alias("b")))
    else:
        out = met.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    return out.where("a <> b").distinct()


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """node, root for every node of ``edges`` (long columns a, b): the smallest node that it reaches.

    Nulls and loops are left out, repeated edges count once; no edges, no rows. Rounds go on until one changes
    nothing, a few more than the logarithm of the longest path. A node with very many neighbours is pre-aggregated and
    joined, never gathered.
    """
    edges = written(edges.where("a <> b").select("a", "b").distinct(), name)
    mark = None
    while True:
        edges = written(_star(_star(edges, small=False), small=True), name)
        now = tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if now == mark:
            break
        mark = now
    roots = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.union(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
