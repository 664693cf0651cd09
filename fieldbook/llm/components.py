"""Connected components of a link table, by alternating star rounds over written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from fieldbook.llm.tables import Scratch


def _is_stars(edges: DataFrame) -> bool:
    """Whether every larger end has one edge and is no edge's smaller end."""
    ends = edges.select(F.col("high").alias("node"), F.lit(1).alias("up")).union(edges.select("low", F.lit(-1)).distinct())
    sums = ends.groupBy("node").agg(F.sum("up").alias("ups"), F.min("up").alias("least"))
    return sums.where("ups > 1 or (least < 0 and ups >= 0)").limit(1).count() == 0


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``component`` (its smallest node) of every node with a link ``low`` - ``high``.

    A large star hangs a node's larger neighbours on the smallest one, a small star its smaller ones;
    in the end every component is a star around its smallest node. Minima are taken by
    aggregates and joined back, so a node with very many links is not gathered in one task. Every round
    is written, and the one before deleted.
    """
    scratch = Scratch(links.sparkSession, "components")
    edges = links.where("low <> high").select(F.least("low", "high").alias("low"), F.greatest("low", "high").alias("high")).distinct()
    edges = scratch.put(edges, "edges")
    while not _is_stars(edges):
        both = edges.union(edges.select("high", "low"))
        centre = both.groupBy(F.col("low").alias("node")).agg(F.min("high").alias("next")).select("node", F.least("node", "next").alias("centre"))
        large = edges.join(centre, F.col("low") == F.col("node")).select(F.col("centre").alias("low"), "high").where("low <> high").distinct()
        centre = large.groupBy(F.col("high").alias("node")).agg(F.min("low").alias("centre"))
        hung = large.join(centre, F.col("high") == F.col("node"))
        small = hung.select(F.col("centre").alias("low"), F.col("low").alias("high")).union(hung.select("centre", "high"))
        edges = scratch.put(small.where("low <> high").distinct(), "edges")
        scratch.keep_only("edges")
    return edges.select(F.col("high").alias("node"), F.col("low").alias("component")).union(
        edges.select("low", "low").distinct()
    )
