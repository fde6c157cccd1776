"""Connected components of a graph whose edges are rows, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from touchline.session import pin


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root``, the smallest node of its component, for every node of ``edges`` (``u``, ``v``).

    Each round hangs all larger neighbours of a node, then all smaller ones, below the smallest, until
    every component is a star. Minima are taken where edges lie before they move, and a node with very
    many edges is split by the join, so no component has to fit into one task. A round's edges go to the
    shared folder; the driver sees their number and a checksum.
    """
    at = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    at, seen = _settle(at)
    while True:
        both = at.unionByName(at.select(F.col("v").alias("u"), F.col("u").alias("v")))
        smallest = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(smallest, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        smallest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(smallest, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        at, now = _settle(small.unionByName(smallest.select("u", F.col("m").alias("v"))).distinct())
        if now == seen:
            break
        seen = now
    roots = at.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return at.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)


def _settle(edges: DataFrame) -> tuple[DataFrame, tuple]:
    kept = pin(edges)
    number = F.xxhash64("u", "v").cast("decimal(38,0)")
    return kept, tuple(kept.agg(F.count("*"), F.sum(number)).first())
