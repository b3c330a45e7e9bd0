"""Connected components by alternating large-star and small-star steps, each a join on aggregated minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import settle


def components(edges: DataFrame, work: str) -> DataFrame:
    """(id, component) for each end of ``edges`` (a, b): component is the least id that can be reached.

    Nothing is collected; each round is written to ``work``. A hub's rows are joined with one
    aggregated row, which adaptive execution splits when they are many.
    """
    links = settle(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v").distinct(), f"{work}/0")
    state, n = None, 0
    while True:
        both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", F.col("m").alias("v"))).distinct()
        n += 1
        links = settle(small, f"{work}/{n}")
        now = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    return links.groupBy("u").agg(F.min("v").alias("v")).select(F.col("u").alias("id"), F.col("v").alias("component")).union(links.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())
