"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.workspace import cut


def components(edges: DataFrame) -> DataFrame:
    """node, root (the smallest node that can be reached) of every node of edges a, b.

    Alternates large-star and small-star steps: every node's neighbours move over to its smallest
    one, which bounds the edges by their first number and ends in stars. Minima are summed up before
    the shuffle and joined back, so no neighbourhood is gathered anywhere. Each round is written to
    the shared folder. Edges with a null end or with two equal ends join nothing; nodes that only
    have such edges are not returned.
    """
    low, high = F.least("a", "b"), F.greatest("a", "b")
    edges = edges.where("a IS NOT NULL AND b IS NOT NULL AND a <> b").select(low.alias("v"), high.alias("u")).distinct()
    state = None
    while True:
        # large star: larger neighbours of u go to the smallest of u and its neighbours
        both = edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # small star: u and its smaller neighbours go to the smallest of them
        large = cut(large, "star")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(least, "u")
        small = joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.unionAll(least.select("u", F.col("m").alias("v"))).distinct()
        edges = cut(small, "star")
        now = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == state:
            break
        state = now
    tips = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return tips.unionAll(tips.select(F.col("root").alias("node"), "root").distinct())
