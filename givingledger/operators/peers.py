"""What other donors gave last year: the mean over all gifts and over the largest ones.

The number of largest gifts is a percentage of the data, so gifts are neither sorted nor limited.
They are counted per amount, and each amount learns how many gifts are larger from running counts
over nested ranges of amounts. A range has at most 2 * 10^5 parts on the level below (dividing cuts
towards zero, so the range around zero is twice as wide), which bounds every window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from givingledger.functions.money import MONEY, TOTAL, up_to_ten
from givingledger.names import (
    ALL_DONOR_AVERAGE,
    TOP_AVERAGE_PREFIX,
    TOP_AVERAGE_SUFFIX,
    TOP_DONOR_AVERAGE,
)
from givingledger.operators.donations import donations_in_window
from givingledger.params import ExportParams

# Range widths from coarse to fine. Amounts have 15 digits before the point and 4 after it.
RANGE_WIDTHS = {"Range1": "100000000000", "Range2": "1000000", "Range3": "10"}
UNKNOWN_RANGE = -(2**63)


def previous_year_amounts(donations: DataFrame, params: ExportParams) -> DataFrame:
    """Amounts of last year's gifts, of one campaign if the parameters name one."""
    gifts = donations_in_window(donations, params.calendar.peer_window)
    if params.average_campaign_id is not None:
        gifts = gifts.filter(F.col("DonationCampaignID") == F.lit(params.average_campaign_id))
    return gifts.select("Amount")


def amount_counts(amounts: DataFrame) -> DataFrame:
    return amounts.groupBy("Amount").agg(F.count(F.lit(1)).alias("Gifts"))


def gifts_to_take(gifts: Column, top_percent: int | None) -> Column:
    """How many gifts are "the largest": the percentage, or all if that gives none or too many."""
    percent = F.lit(1 if top_percent == 0 else top_percent).cast("bigint")
    share = F.call_function("div", gifts * percent, F.lit(100))
    return F.when(share.between(F.lit(1), gifts), share).otherwise(gifts)


def summary(counts: DataFrame, top_percent: int | None) -> DataFrame:
    """One row: number and sum of gifts, and how many to take. Gifts without an amount count."""
    return counts.agg(
        F.coalesce(F.sum("Gifts"), F.lit(0)).alias("Gifts"),
        F.sum(F.col("Amount") * F.col("Gifts")).cast(TOTAL).alias("Donated"),
    ).withColumn("Take", gifts_to_take(F.col("Gifts"), top_percent))


def larger_gifts(counts: DataFrame) -> DataFrame:
    """Amounts with the number of gifts of a larger amount (``Larger``).

    Every level starts from ``counts``. Unknown amounts get a lowest range of their own instead of
    NULL: joins then imply no filters, all levels read the same plan, and Spark runs it once.
    """
    ranged = counts.withColumns(
        {
            name: F.coalesce(
                F.call_function("div", F.col("Amount"), F.lit(width).cast(MONEY)),
                F.lit(UNKNOWN_RANGE),
            )
            for name, width in RANGE_WIDTHS.items()
        }
    )
    levels = (*RANGE_WIDTHS, "Amount")
    ranks = _larger_in_range(ranged, [], levels[0])
    for depth in range(1, len(levels)):
        outer = list(levels[:depth])
        outside = ranks.select(*outer, F.col("Larger").alias("LargerOutside"))
        ranks = (
            _larger_in_range(ranged, outer, levels[depth])
            .join(outside, outer)
            .withColumn("Larger", F.col("Larger") + F.col("LargerOutside"))
            .select(*outer, levels[depth], "Gifts", "Larger")
        )
    return ranks


def _larger_in_range(ranged: DataFrame, outer: list[str], level: str) -> DataFrame:
    """Gifts per part of each outer range, and how many of that range are in larger parts."""
    within = Window.partitionBy(*(outer or [F.lit(0)])).orderBy(F.desc_nulls_last(level))
    before = within.rowsBetween(Window.unboundedPreceding, -1)
    return (
        ranged.groupBy(*outer, level)
        .agg(F.sum("Gifts").alias("Gifts"))
        .withColumn("Larger", F.coalesce(F.sum("Gifts").over(before), F.lit(0)))
    )


def top_total(counts: DataFrame, totals: DataFrame) -> DataFrame:
    """One row: the sum of the ``Take`` largest amounts, NULL if there are none."""
    still_wanted = F.col("Take") - F.col("Larger")
    taken = F.greatest(F.lit(0), F.least(F.col("Gifts"), still_wanted))
    return (
        larger_gifts(counts)
        .crossJoin(F.broadcast(totals.select("Take")))  # one row
        .agg(F.sum(F.col("Amount") * taken).cast(TOTAL).alias("TopDonated"))
    )


def peer_averages(donations: DataFrame, params: ExportParams) -> DataFrame:
    """One row: both means as sums and counts, and rounded up to tens (NULL without any gift)."""
    counts = amount_counts(previous_year_amounts(donations, params))
    totals = summary(counts, params.top_percent)
    top = top_total(counts, totals)

    def mean(total: str, number: str) -> Column:
        return F.expr(up_to_ten(f"{total} / nullif({number}, 0)"))

    any_gift = F.col("Gifts") > 0
    return totals.crossJoin(F.broadcast(top)).select(
        "Gifts",
        "Take",
        "Donated",
        "TopDonated",
        F.when(any_gift, mean("Donated", "Gifts")).alias(ALL_DONOR_AVERAGE),
        F.when(any_gift, mean("TopDonated", "Take")).alias(TOP_DONOR_AVERAGE),
    )


def top_average_sentence(params: ExportParams) -> Column:
    """A sentence on the largest gifts, if asked for and known; over :func:`peer_averages`."""
    average = F.col(TOP_DONOR_AVERAGE).cast("bigint").cast("string")
    sentence = F.concat(F.lit(TOP_AVERAGE_PREFIX), average, F.lit(TOP_AVERAGE_SUFFIX))
    wanted = F.lit(params.include_top_average_sentence) & F.col(TOP_DONOR_AVERAGE).isNotNull()
    return F.when(wanted, sentence).otherwise("")
