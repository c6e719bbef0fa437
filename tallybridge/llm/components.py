"""Connected components of a link table, without a hub in one task or links on the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def connected_components(links: DataFrame) -> DataFrame:
    """``a``, ``b`` links to (node, component), the smallest node reachable.

    Nodes without a link to another node do not appear; a null end makes a row no link.
    Alternates the large-star and small-star steps until nothing changes, a number of rounds
    that grows with the logarithm of the nodes. Every round is a minimum per node, combined
    before its shuffle and written, and a join back, whose hot keys adaptive execution splits
    since both sides are plain tables; what it leaves is at most one row per link.
    """
    edges = stored(
        links.dropna(subset=["a", "b"])
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .filter("u <> v")
        .distinct(),
        "links",
    )
    before = None
    while True:
        both = edges.union(edges.select("v", "u"))
        lowest = stored(both.groupBy("u").agg(F.min("v").alias("v")).select("u", F.least("u", "v").alias("m")), "lowest")
        large = both.filter("v > u").join(lowest, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = stored(large, "large-stars")
        lowest = stored(large.groupBy("u").agg(F.min("v").alias("m")), "lowest")
        small = (
            large.join(lowest, "u")
            .select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
            .select("e.u", "e.v")
            .filter("u <> v")
            .distinct()
        )
        edges = stored(small, "stars")
        now = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
                edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
            )
        before = now
