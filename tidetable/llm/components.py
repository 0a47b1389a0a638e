"""Connected components of links, as alternating star operations on an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidetable.llm.shared import materialize


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node's larger neighbours to the smallest of its neighbourhood."""
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node and its smaller neighbours to the smallest of these."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    others = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return others.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def _state(edges: DataFrame):
    return edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``links`` (two columns of one type) but the roots: the smallest node reachable.

    Each round is written to the shared folder. The rounds end when the edges are stars, after a number of them that
    grows with the logarithm of the size.
    """
    a, b = links.columns
    edges = materialize(
        links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()
    )
    before = None
    while (now := _state(edges)) != before:
        before = now
        edges = materialize(_small_star(_large_star(edges)))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
