"""Connected components of a graph that only Spark holds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablebridge.llm.common import discard, kept


def _fingerprint(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % 1_000_003)).first()
    return row[0], row[1] or 0


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every end of an edge ``(u, v)``; the root is the smallest node of the component.

    Turns of large stars and small stars (every node hands its larger, then its smaller neighbours to the smallest one)
    until nothing changes; the number of turns grows with the logarithm of the graph. The smallest neighbours are
    written out before they are joined, so Spark can split a hub's rows over many tasks.
    """
    edges = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v").distinct()
    edges = kept(edges, "components")
    before = (0, 0)
    while (now := _fingerprint(edges)) != before:
        before, old = now, edges
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = kept(both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m")), "components-least")
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
        large = kept(large.distinct(), "components-large")
        discard(least)
        least = kept(large.groupBy("u").agg(F.min("v").alias("m")), "components-least")
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
        edges = kept(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "components")
        discard(old, large, least)
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
