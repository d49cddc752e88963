"""Connected components of an undirected graph given as an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layerforge.llm.common import stage


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root): root is the smallest node reachable.  Nodes without an edge are absent.

    Alternating large-star and small-star rounds: each links a node's neighbours to the smallest
    of them, so chains shrink by halves.  Minima are pre-aggregated; the joins are plain equi-joins
    that can be split at a hub.  Every round is staged; the loop ends when the edges stand still.
    """
    links = stage(edges.where(F.col(a) != F.col(b))
                  .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "links")
    mark = None
    while True:
        both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        # Large star: larger neighbours go to the smallest of the neighbourhood.
        large = (both.where("v > u").join(least, "u").where("v != m")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        # Small star: smaller neighbours, and the node itself, go to the smallest of them.
        lower = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(lower, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(lower.select("u", F.col("m").alias("v"))).distinct())
        links = stage(small, "links")
        seen = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).head()
        if tuple(seen) == mark:
            break
        mark = tuple(seen)
    return links.groupBy("u").agg(F.min("v").alias("root")).select(F.col("u").alias("node"), "root").unionByName(
        links.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
