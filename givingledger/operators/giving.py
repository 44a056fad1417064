"""What each donor gave: one grouped pass over the donations, in two steps.

Step one sums per donor, fiscal window and giving year. Its rows are narrow, Spark combines them
before the shuffle, and its key spreads a donor with very many gifts over several tasks. Step two
turns the few rows left of each donor into the wide row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from givingledger.functions.fiscal import WINDOW_COUNT, shift_years, timestamp
from givingledger.functions.keys import (
    amount_date_key,
    amount_of_date_key,
    date_amount_key,
    date_of_amount_key,
    date_of_date_key,
)
from givingledger.functions.money import (
    MONEY,
    TOTAL,
    currency,
    percent_change,
    valued_amount,
)
from givingledger.names import (
    CURRENT_DONOR,
    FORMER_DONOR,
    LAPSED,
    LAPSING,
    NEVER_DONATED,
    YEARS_BACK,
)
from givingledger.params import ExportParams

DONOR = "DonorProfileID"

# An unknown flag is neither yes nor no.
GIFT_KINDS = {
    "Plain": "NOT IsStock AND NOT InKind",
    "Stock": "IsStock",
    "InKind": "InKind",
    "NotStock": "NOT IsStock",
    "NotInKind": "NOT InKind",
}


def giving_history(donations: DataFrame, params: ExportParams) -> DataFrame:
    """One row per donor, fiscal window and giving year (both NULL where they do not apply).

    The first, last and largest gift are whole numbers made of date and amount: gifts of the same
    moment are told apart by amount, and a gift without a date comes before all others. All
    aggregates are hash aggregates, so gifts are combined before the shuffle and never sorted.
    """
    calendar = params.calendar
    gifts = donations.filter(F.col(DONOR).isNotNull()).select(
        DONOR,
        "Amount",
        "DonatedOn",
        "IsStock",
        "InKind",
        valued_amount().alias("ValuedAmount"),
        calendar.years_back("DonatedOn").alias("YearsBack"),
        calendar.giving_year("DonatedOn").alias("GivingYear"),
        F.expr(date_amount_key("DonatedOn", "Amount")).alias("DateAmount"),
        F.expr(amount_date_key("Amount", "DonatedOn")).alias("AmountDate"),
    )

    return gifts.groupBy(DONOR, "YearsBack", "GivingYear").agg(
        F.sum("Amount").alias("Donated"),
        F.count("Amount").alias("Priced"),
        F.sum("ValuedAmount").alias("Valued"),
        *[
            F.expr(f"count(DonatedOn) FILTER (WHERE {condition}) AS {name}")
            for name, condition in GIFT_KINDS.items()
        ],
        F.max("DonatedOn").alias("LastOn"),
        F.max("Amount").alias("LargestAmount"),
        F.min("DateAmount").alias("FirstKey"),
        F.max("DateAmount").alias("LastKey"),
        F.max("AmountDate").alias("LargestKey"),
    )


def donor_rollup(history: DataFrame) -> DataFrame:
    """One row per donor who gave.

    Distinct giving years are counted where they begin in the year order of a donor's rows, which
    keeps every aggregate mergeable in place and leaves the rows sorted for the join that follows.
    """
    by_year = Window.partitionBy(DONOR).orderBy("GivingYear")
    year = F.col("GivingYear")
    marked = history.withColumn(
        "NewYear",
        F.when(year.isNotNull() & ~F.lag(year).over(by_year).eqNullSafe(year), 1).otherwise(0),
    )

    within = {
        "PlainThisYear": ("Plain", 0),
        "NotStockThisYear": ("NotStock", 0),
        "NotInKindThisYear": ("NotInKind", 0),
        "PlainLastYear": ("Plain", 1),
        "StockLastYear": ("Stock", 1),
        "InKindLastYear": ("InKind", 1),
        **{f"Donated{back}": ("Donated", back) for back in range(WINDOW_COUNT)},
        **{f"Valued{back}": ("Valued", back) for back in range(WINDOW_COUNT)},
    }
    lifetime = ("Plain", "Stock", "InKind", "Donated", "Priced")
    return marked.groupBy(DONOR).agg(
        F.sum("NewYear").alias("YearsGiven"),
        *[F.sum(name).alias(name) for name in lifetime],
        F.min("FirstKey").alias("FirstKey"),
        *[F.max(name).alias(name) for name in ("LastOn", "LargestAmount", "LastKey", "LargestKey")],
        *[
            F.expr(f"sum({column}) FILTER (WHERE YearsBack = {back}) AS {name}")
            for name, (column, back) in within.items()
        ],
    )


def join_giving(donors: DataFrame, rollup: DataFrame) -> DataFrame:
    """Donors with their rollup. ``HasGiven`` is NULL for those without any donation.

    Window sums become zero there and get their final type here, once, since each of them enters
    several output columns.
    """
    sums = [f"{kind}{back}" for kind in ("Donated", "Valued") for back in range(WINDOW_COUNT)]
    settled = {name: F.expr(f"CAST(coalesce({name}, 0) AS {TOTAL})") for name in sums}
    given = rollup.withColumn("HasGiven", F.lit(True))
    return donors.join(given, DONOR, "left").withColumns(settled)


def with_giving(donors: DataFrame, donations: DataFrame, params: ExportParams) -> DataFrame:
    return join_giving(donors, donor_rollup(giving_history(donations, params)))


# ---- output columns over a row of join_giving, as SQL text by name ----------------------------


def _count(column: str) -> str:
    return f"coalesce({column}, 0L)"


def donated(years_back: int) -> str:
    """Amounts of a window, 0 for none."""
    return f"Donated{years_back}"


def valued(years_back: int) -> str:
    """The same at fair market value."""
    return f"Valued{years_back}"


def status_columns(params: ExportParams) -> dict[str, str]:
    start = params.calendar.start
    since = {CURRENT_DONOR: 0, LAPSING: -1, LAPSED: -3}
    tiers = [
        f"WHEN LastOn > {timestamp(shift_years(start, years))} THEN '{status}'"
        for status, years in since.items()
    ]
    text = f"CASE WHEN HasGiven IS NULL THEN '{NEVER_DONATED}' {' '.join(tiers)}"
    return {"DonorStatus": f"{text} ELSE '{FORMER_DONOR}' END"}


def lifetime_columns() -> dict[str, str]:
    return {
        "LifetimeDonatedAmount": f"CAST(Donated AS {TOTAL})",
        "AverageDonationAmount": f"CAST(CAST(Donated AS {TOTAL}) / nullif(Priced, 0) AS {MONEY})",
    }


def first_gift_columns() -> dict[str, str]:
    return {
        "FirstDonationDate": date_of_date_key("FirstKey"),
        "FirstDonationAmount": amount_of_date_key("FirstKey"),
    }


def last_gift_columns() -> dict[str, str]:
    return {"LastDonationAmount": amount_of_date_key("LastKey"), "LastDonationDate": "LastOn"}


def largest_gift_columns() -> dict[str, str]:
    return {
        "LargestDonationAmount": "LargestAmount",
        "LargestDonationDate": date_of_amount_key("LargestKey"),
    }


def years_given_columns() -> dict[str, str]:
    return {"TotalYearsGiven": _count("YearsGiven")}


def lifetime_count_columns() -> dict[str, str]:
    return {
        "NumberOfGiftsAndPledgesLifetime": _count("Plain"),
        "NumberOfStockDonationsLifetime": _count("Stock"),
        "NumberOfInKindDonationsLifetime": _count("InKind"),
    }


def this_year_count_columns() -> dict[str, str]:
    """The stock and in-kind counts of the current year count gifts that are *not* of the kind."""
    return {
        "NumberOfGiftsAndPledgesYearToDate": _count("PlainThisYear"),
        "NumberOfStockDonationsYearToDate": _count("NotStockThisYear"),
        "NumberOfInKindDonationsYearToDate": _count("NotInKindThisYear"),
    }


def last_year_count_columns() -> dict[str, str]:
    return {
        "NumberOfGiftsAndPledgesLastFiscalYear": _count("PlainLastYear"),
        "NumberOfStockDonationsLastFiscalYear": _count("StockLastYear"),
        "NumberOfInKindDonationsLastFiscalYear": _count("InKindLastYear"),
    }


def window_total_columns() -> dict[str, str]:
    return {f"Donated{YEARS_BACK[k]}YearsAgo": donated(k) for k in range(2, WINDOW_COUNT)}


def window_formatted_columns() -> dict[str, str]:
    return {
        f"Donated{YEARS_BACK[k]}YearsAgoFormatted": currency(donated(k))
        for k in range(2, WINDOW_COUNT)
    }


def window_valued_columns() -> dict[str, str]:
    """Fair market value of the windows that enter a percent change."""
    return {f"Valued{k}": valued(k) for k in range(WINDOW_COUNT - 1)}


def last_year_columns() -> dict[str, str]:
    """Named for last year, and holding the current window."""
    return {"DonatedLastYear": valued(0), "DonatedLastYearFormatted": currency(valued(0))}


def previous_three_years_columns() -> dict[str, str]:
    """Named for three years, and holding the window three years back."""
    return {"DonatedPreviousThreeYears": valued(3)}


def percent_change_columns() -> dict[str, str]:
    """Valued gifts of one window against plain amounts of another.

    The first one is a number and compares with the current window; the others are texts, and the
    second one sets the current window against the one two years back.
    """
    first = percent_change(valued(1), donated(0))
    columns = {"PercentChangeFromLastFiscalYear": f"CAST({first} AS {MONEY})"}
    for base in range(2, WINDOW_COUNT):
        newer = 0 if base == 2 else base - 1
        name = f"PercentChangeFrom{YEARS_BACK[base]}FYAgoTo{YEARS_BACK[base - 1]}FYAgo"
        columns[name] = f"CAST({percent_change(valued(newer), donated(base))} AS string)"
    return columns


def giving_columns(params: ExportParams) -> dict[str, str]:
    """Every output column that derives from a donor's own gifts."""
    return {
        **status_columns(params),
        **years_given_columns(),
        **lifetime_count_columns(),
        **lifetime_columns(),
        **first_gift_columns(),
        **last_gift_columns(),
        **largest_gift_columns(),
        **previous_three_years_columns(),
        **this_year_count_columns(),
        **last_year_count_columns(),
        **last_year_columns(),
        **percent_change_columns(),
        **window_total_columns(),
        **window_formatted_columns(),
    }


def window_label_columns(params: ExportParams) -> dict[str, str]:
    """The bounds of every window, the same for all donors."""
    current, last, *earlier = params.calendar.windows
    return {
        "FiscalYearToDate": f"'{current.label}'",
        "FiscalLastYear": f"'{last.label}'",
        **{f"Fiscal{YEARS_BACK[w.years_back]}YearsAgo": f"'{w.label}'" for w in earlier},
    }
