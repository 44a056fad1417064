"""Text helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def comparable(value: Column, ignore_case: bool) -> Column:
    """A text as it takes part in comparisons and groups."""
    return F.lower(F.rtrim(value)) if ignore_case else value


def sorted_join(value: str, separator: str) -> Column:
    """Texts of a group joined in text order; NULLs are skipped, and NULL if none is left."""
    return F.expr(f"listagg({value}, '{separator}') WITHIN GROUP (ORDER BY {value})")


def blank_if_null(value: Column) -> Column:
    return F.coalesce(value, F.lit(""))
