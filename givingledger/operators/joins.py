"""Joins that stay even when keys are unknown or very frequent."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lookup(rows: DataFrame, table: DataFrame, key: str, *spread_by: str) -> DataFrame:
    """Left join of ``table`` by ``key``.

    Rows without a key match nothing, yet hashing by the key alone would send all of them to one
    task; here they are spread by other columns. The second join key also makes Spark shuffle
    ``table`` for this join even if it is laid out by ``key`` already, and only between two
    shuffles does adaptive execution split a frequent key over several tasks.
    """
    group = F.hash(*spread_by)
    grouped_rows = rows.withColumn("_Group", F.when(F.col(key).isNull(), group).otherwise(0))
    # Always 0, in a form that the optimizer does not fold into a constant.
    grouped_table = table.withColumn("_Group", F.pmod(F.hash(key), F.lit(1)))
    return grouped_rows.join(grouped_table, [key, "_Group"], "left").drop("_Group")


def union_of(frames: list[DataFrame]) -> DataFrame:
    """The rows of all frames; of a single one, that frame with its layout."""
    return reduce(DataFrame.unionByName, frames)
