"""Money arithmetic and formats, as SQL text over column names or other expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# One amount, and a sum of amounts: ten more digits, so totals over all donors cannot overflow.
MONEY = "decimal(19,4)"
TOTAL = "decimal(29,4)"


def valued_amount() -> Column:
    """A gift's worth: fair market value for unpriced gifts in kind and for valued stock."""
    in_kind_value = F.col("InKindFairMarketValue")
    stock_value = F.col("StockFairMarketValue")
    unpriced = F.col("InKind") & (F.col("Amount") == 0) & (in_kind_value > 0)
    return (
        F.when(unpriced, in_kind_value)
        .when(F.col("IsStock") & stock_value.isNotNull(), stock_value)
        .otherwise(F.col("Amount"))
    )


# Differences below this many units, in ten-thousandths and over the smallest base, fit a bigint.
NARROW = 90_000_000_000
PERCENT = "decimal(38,2)"


def percent_change(new: str, base: str) -> str:
    """Change from ``base`` in percent, with two decimals.

    The ratio is cut after four decimals, not rounded. NULL for a zero base. ``DIV`` gives a bigint, which is enough below ``NARROW``;
    above, the remainder is taken off first, so that the quotient is whole in decimals. A ratio of more than 32 digits in
    ten-thousandths is an overflow error, never another number.
    """
    change, divisor = f"({new} - {base})", f"nullif({base}, 0)"
    units = f"CAST({change} AS decimal(30,4)) * 10000BD"
    narrow = f"CAST({change} * 10000 DIV {divisor} AS decimal(36,0))"
    wide = f"CAST(({units} - {units} % {divisor}) / {divisor} AS decimal(36,0))"
    return f"CAST(CASE WHEN abs({change}) < {NARROW} THEN {narrow} ELSE {wide} END * 0.01BD AS {PERCENT})"


def two_decimals(amount: str) -> str:
    return f"CAST(CAST({amount} AS decimal(31,2)) AS string)"


def currency(amount: str) -> str:
    """$1,234.50, and ($1,234.50) below zero. Rounded first: format_number rounds half to even."""
    return f"format_number(round({amount}, 2), '$#,##0.00;($#,##0.00)')"


def whole_dollars(amount: str) -> str:
    """$1,234, and -$1,234 below zero. Adding zero turns a rounded -0.0 into 0.0."""
    return f"format_number(round({amount}, 0) + 0.0D, '$#,##0')"


def up_to_ten(amount: str) -> str:
    """Next multiple of ten; 0 for NULL."""
    return f"coalesce(CAST(ceil(CAST({amount} AS double) / 10) AS double) * 10, 0.0D)"
