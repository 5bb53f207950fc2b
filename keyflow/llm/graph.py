"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import forget, save


def components(links: DataFrame) -> DataFrame:
    """``id, component`` (the smallest id reachable) of every id in ``links`` (columns ``x, y``).

    Every round rewires edges towards smaller neighbours and is written to the
    shared folder; rounds end when the edges no longer change, after about
    the logarithm of the longest path.  A hub's edges are aggregated before
    they are shuffled, and joins on it can be split.
    """
    edges = save(links.select(F.greatest("x", "y").alias("u"), F.least("x", "y").alias("v")).filter("u <> v").distinct())
    mark = None
    while True:
        both = edges.union(edges.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
        before, edges = edges, save(small.union(least).distinct())
        forget(before)
        was, mark = mark, edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if was == mark:
            return edges.select(F.col("u").alias("id"), F.col("v").alias("component"))
