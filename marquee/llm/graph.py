"""Connected components of a link table, as a sequence of Spark jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import stored


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node of ``links``; component is the smallest node reachable.

    Alternates the large-star and small-star steps: each node hangs its larger
    neighbours, then its smaller ones, under its smallest neighbour.  A node's
    minimum is a partial aggregate joined back, so a hub with very many links
    is never one task's group.  Every round is a stored table; the number of
    rounds grows with the logarithm of the longest chain."""
    edges = stored(links.where(F.col(a) != F.col(b)).select(
        F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "links")
    while True:
        both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (both.where("v > u").join(least, "u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct())
        root = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(root, "u")
                 .select(F.explode(F.array(F.struct(F.col("u"), F.col("m").alias("v")),
                                           F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
                 .select("e.u", "e.v").where("u != v").distinct())
        after = stored(small, "links")
        # a fixpoint is a set of stars: every u has one v, and no v is itself a u
        tangled = (after.groupBy("u").count().where("count > 1").select("u")
                   .unionAll(after.join(after.select(F.col("v").alias("u")).distinct(), "u", "left_semi").select("u")))
        edges = after
        if tangled.isEmpty():
            break
    return (edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
            .unionAll(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()))
