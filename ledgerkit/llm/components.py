"""Connected components of links, by alternating star contraction: no node's neighbours meet in one place."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerkit.llm.scratch import stored


def _state(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.lit(0))).first()
    return row[0], int(row[1])


def _stars(edges: DataFrame, lower: Column, smallest: Column) -> DataFrame:
    """Per node the smallest of ``smallest``; the node's other neighbours chosen by ``lower`` point to it."""
    least = edges.groupBy("u").agg(F.least(F.min(smallest), F.col("u")).alias("m"))
    moved = edges.filter(lower).join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (a long, b long): component is the smallest node reachable.

    Both steps keep what is connected; they end when every node points to its component's smallest. A node with many
    neighbours costs one row for each, minima are combined before they move, and the join may split its rows.
    """
    edges = stored(
        links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct(), "edges"
    )
    before = _state(edges)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _stars(both, F.col("v") > F.col("u"), F.col("v"))
        edges = stored(_stars(large, F.col("v") < F.col("u"), F.col("v")), "edges")
        after = _state(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
