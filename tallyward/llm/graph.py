"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyward.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``component`` (the smallest node) for all nodes of ``links`` (a, b); nodes of any ordered type.

    Alternates large-star and small-star steps: each node points its larger (then smaller) neighbours to the smallest node
    it knows, so paths halve with each round and every round writes at most as many links as there were. Rounds end when
    the links no longer change. Links with a NULL end or from a node to itself are ignored.
    """
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct()
    edges = stored(edges, "edges")
    seen = _state(edges)
    while seen[0]:
        edges = stored(_small_star(_large_star(edges)).distinct(), "edges")
        now = _state(edges)
        if now == seen:
            break
        seen = now
    heads = edges.select(F.col("v").alias("node")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        heads.select("node", F.col("node").alias("component"))
    )


def _state(edges: DataFrame) -> tuple:
    """A digest of the set of links (all different), in any order."""
    hashed = F.xxhash64("u", "v").cast("decimal(38,0)")
    again = F.xxhash64(F.lit(3), "u", "v").cast("decimal(38,0)")
    return tuple(edges.agg(F.count("*"), F.sum(hashed), F.sum(again)).first())


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node's larger neighbours, linked to the smallest node of its neighbourhood."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours, linked to the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    smaller = edges.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return smaller.unionByName(least.select("u", F.col("m").alias("v")))
