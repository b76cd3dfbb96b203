"""Connected components by alternating stars, as joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import stored


def _least(edges: DataFrame) -> DataFrame:
    return edges.groupBy("u").agg(F.min("v").alias("m"))


def connected_components(links: DataFrame) -> DataFrame:
    """``links(a, b)`` of long ids to ``(id, component)``: each linked id with the least id reachable.

    Large and small star in turn (Kiveris et al., 2014): every node hands its larger (smaller)
    neighbours over to its least neighbour until nothing changes, in O(log² n) rounds. A node with
    very many neighbours is only aggregated (with a partial step) and joined, never gathered.
    """
    edges = stored(
        links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
        "links")
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = _least(both).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        # Each edge now points down: small star joins the lower neighbours to the least of them.
        large = stored(large.where("u <> v").distinct(), "large-star")
        least = _least(large)
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        after = stored(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "small-star")
        # Done when every node has one lower neighbour, and that one has none.
        chained = after.select("v").join(after.select(F.col("u").alias("v")), "v", "left_semi")
        forked = after.groupBy("u").count().where("count > 1").select("u")
        if chained.unionByName(forked.withColumnRenamed("u", "v")).isEmpty():
            members = after.select(F.col("u").alias("id"), F.col("v").alias("component"))
            return members.unionByName(members.select(F.col("component").alias("id"), "component").distinct())
        edges = after
