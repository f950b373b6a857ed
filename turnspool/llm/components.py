"""Connected components by alternating stars; links and components stay in tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnspool.staging import stage


def _digest(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(row)


def components(links: DataFrame) -> DataFrame:
    """``(node, root)`` of every node in ``links (u, v)``; the root is the smallest node reached.

    A round hangs every larger neighbour of a node on the smallest, then every smaller one. The
    number of rounds grows with the logarithm of the longest chain. Each round is a written table.
    """
    edges = stage(
        links.filter("u <> v")
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct(),
        "links",
    )
    before = _digest(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = (
            both.join(low, "u")
            .filter("v > u")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .distinct()
        )
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").filter("v <> m").select(
            F.col("v").alias("u"), F.col("m").alias("v")
        )
        edges = stage(
            small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "links"
        )
        after = _digest(edges)
        if after == before:
            break
        before = after
    nodes = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return nodes.unionByName(roots)
