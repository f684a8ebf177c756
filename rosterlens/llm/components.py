"""Connected components of a graph that does not fit one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize


def _signature(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def connected_components(links: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of the links ``(u, v)``; root is the smallest node that can be reached.

    Alternates the large-star and small-star steps: every node's neighbours move to the smallest of them, until nothing
    changes. A hub's neighbours are never gathered: least neighbours are a table before they are joined, so both sides of
    each join come from tables and Spark splits a hub over tasks. Each step starts from a table in the shared folder.
    Loops and repeated links are harmless, nulls are dropped; no links make no rows.
    """
    edges = links.where("u is not null and v is not null and u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    edges = materialize(edges, "links")
    before = _signature(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = materialize(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("m", "u").alias("m")), "least")
        large = materialize(both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "large")
        lowest = materialize(large.groupBy("u").agg(F.min("v").alias("m")), "lowest")
        small = large.join(lowest, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = materialize(small.unionByName(lowest.select("u", F.col("m").alias("v"))).distinct(), "links")
        after = _signature(edges)
        if after == before:
            break
        before = after
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
