"""Connected components by alternating large and small stars, distributed, with each round's links in a stored table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from givingledger.llm.common import written


def lowest(links: DataFrame) -> DataFrame:
    """(u, low): the smallest of u and its neighbours."""
    return links.groupBy("u").agg(F.least("u", F.min("v")).alias("low"))


def large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return both.join(lowest(both), "u").filter("v > u").select(F.col("v").alias("u"), F.col("low").alias("v")).distinct()


def small_star(links: DataFrame) -> DataFrame:
    """links go from larger to smaller ids."""
    low = lowest(links)
    moved = links.join(low, "u").filter("v != low").select(F.col("v").alias("u"), F.col("low").alias("v"))
    return moved.unionByName(low.select("u", F.col("low").alias("v"))).distinct()


def stars(links: DataFrame) -> bool:
    """Whether each id has one link at most to a smaller id, and that id none: then it is the smallest that is reached."""
    ends = links.select(F.explode(F.array(F.struct(F.col("u").alias("id"), F.lit(1).alias("down")),
                                          F.struct(F.col("v").alias("id"), F.lit(0).alias("down")))).alias("end"))
    counts = ends.groupBy("end.id").agg(F.count(F.lit(1)).alias("n"), F.sum("end.down").alias("down"))
    return counts.filter("down > 1 OR down = 1 AND n > 1").isEmpty()


def components(links: DataFrame) -> DataFrame:
    """(id, component) for each id in links (a, b): the smallest id that it reaches."""
    pairs = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u != v").distinct()
    current = written(pairs, "links")
    while not stars(current):
        current = written(small_star(large_star(current)), "links")
    return current.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(
        current.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())
