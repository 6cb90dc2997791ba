"""Connected components of a table of links, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import materialise


def components(links: DataFrame) -> DataFrame:
    """node and comp (its smallest reachable node) for the nodes of links (a, b), of any type that has an order.

    A large-star step joins each node's larger neighbours to its smallest one, a small-star step its smaller ones; the table never
    grows, is halved in depth by each pair of steps, and stays on disk: nothing of it goes to the driver. Copies of a link count once.
    """
    state = materialise(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u != v").distinct())
    while True:
        both = state.union(state.select("v", "u"))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v")).filter("u != v")
        after = materialise(small.union(least.select("u", F.col("m").alias("v"))).distinct())
        # done if no end of a link is the start of another: all links point to the smallest node of their star
        settled = not after.join(after.select(F.col("u").alias("v")).distinct(), "v", "left_semi").limit(1).count() and not after.groupBy("u").count().filter("count > 1").limit(1).count()
        state = after
        if settled:
            break
    return state.select(F.col("u").alias("node"), F.col("v").alias("comp")).union(state.select("v", "v").distinct())
