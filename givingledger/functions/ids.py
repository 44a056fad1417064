"""Ids as whole numbers that sort like the ids, so that the smallest id is found by hash aggregates.

A hash aggregate updates its values in place and so can hold numbers, but not texts: a minimum of texts has all rows sorted first.
GUID text in its usual form (32 hexadecimal digits in lower case, in groups of 8, 4, 4, 4 and 12) is two numbers of 64 bits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, IntegralType

GUID = "^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$"
HALF = "decimal(20,0)"  # 64 bits without a sign
# A 64-bit place in front of a tag of 33 bits, in one decimal(38,0); beyond them the place of an unknown id, which comes last.
TAG_SPAN = 2**33
LONG_ZERO = 2**63
UNKNOWN = 10**37


def is_number(kind: DataType) -> bool:
    return isinstance(kind, IntegralType)


def guid_halves(guid: Column) -> tuple[Column, Column]:
    digits = F.replace(guid, F.lit("-"))
    high, low = (F.conv(F.substring(digits, start, 16), 16, 10).cast(HALF) for start in (1, 17))
    return high, low


def guid_of(high: Column, low: Column) -> Column:
    """The text of two halves; NULL if one is."""
    digits = F.concat(*[F.lpad(F.lower(F.conv(half.cast("string"), 10, 16)), 16, "0") for half in (high, low)])
    parts = [F.substring(digits, start, size) for start, size in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.when(digits.isNotNull(), F.concat_ws("-", *parts))


def tagged(place: str, tag: str) -> str:
    """SQL text: a place of 64 bits without a sign and an int (unknown first) as one number that sorts like the pair."""
    code = f"coalesce(CAST({tag} AS BIGINT) + {2**31 + 1}L, 0L)"
    known = f"CAST({place} AS {HALF}) * {TAG_SPAN}BD"
    return f"CAST(coalesce(CAST({known} AS DECIMAL(38,0)), {UNKNOWN}BD) + {code} AS DECIMAL(38,0))"


def place_of(number: str) -> str:
    exact = f"CAST(({number} - {number} % {TAG_SPAN}BD) / {TAG_SPAN}BD AS {HALF})"
    return f"CASE WHEN {number} < {UNKNOWN}BD THEN {exact} END"


def tag_of(number: str) -> str:
    bare = f"CASE WHEN {number} < {UNKNOWN}BD THEN {number} ELSE {number} - {UNKNOWN}BD END"
    code = f"CAST(({bare}) % {TAG_SPAN}BD AS BIGINT)"
    return f"CASE WHEN {code} > 0 THEN CAST({code} - {2**31 + 1}L AS INT) END"


def smallest_guids(rows: DataFrame, group: str, ids: dict[str, str]) -> DataFrame:
    """One row per group with the smallest of each kind of id.

    ``rows`` has the group, ``Kind`` and ``ID`` (GUID text); ``ids`` names the result column of each kind. First the least low half
    for each high half, then that of the least high half.
    """
    high, low = guid_halves(F.col("ID"))
    halves = rows.select(group, "Kind", high.alias("High"), low.alias("Low")).filter(F.col("High").isNotNull())
    by_high = halves.groupBy(group, "Kind", "High").agg(F.min("Low").alias("Low"))
    chosen = []
    for kind, name in ids.items():
        chosen += [
            F.expr(f"min(High) FILTER (WHERE Kind = '{kind}') AS {name}High"),
            F.expr(f"min_by(Low, High) FILTER (WHERE Kind = '{kind}') AS {name}Low"),
        ]
    found = by_high.groupBy(group).agg(*chosen)
    return found.select(
        group, *[guid_of(F.col(f"{name}High"), F.col(f"{name}Low")).alias(name) for name in ids.values()]
    )
