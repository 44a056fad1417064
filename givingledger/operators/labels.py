"""Texts that list what a donor gave to, and the giving levels of a form."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from givingledger.functions.money import TOTAL, two_decimals
from givingledger.functions.text import comparable, sorted_join
from givingledger.params import ExportParams
from givingledger.sources.tables import DonorTables

DONOR = "DonorProfileID"
SEPARATOR = ", "

Purposes = dict[str, tuple[str, DataFrame]]


def title_totals(
    donations: DataFrame, purposes: Purposes, ignore_case: bool = False
) -> DataFrame:
    """What each donor gave per purpose (campaign, fund, appeal) and title.

    ``purposes`` maps a purpose to the id column it uses and the table that gives ids a title.
    The donations are read once for all purposes. Gifts are summed per donor and combination of ids
    first, so that the first shuffle has at most one row for a gift and not one for each purpose;
    then per donor and id, before titles are looked up, so the join carries sums and not gifts. Equal titles add up; of titles that
    differ in case only, the first in text order is shown.
    """
    keys = [key for key, _ in purposes.values()]
    tagged_ids = [
        F.struct(F.lit(name).alias("Purpose"), F.col(key).alias("ID"))
        for name, (key, _) in purposes.items()
    ]
    gifts = donations.filter(F.col(DONOR).isNotNull()).groupBy(DONOR, *keys).agg(F.sum("Amount").alias("Amount"))
    per_id = (
        gifts.select(DONOR, "Amount", F.explode(F.array(*tagged_ids)).alias("Given"))
        .select(DONOR, "Amount", "Given.Purpose", "Given.ID")
        .filter(F.col("ID").isNotNull())
        .groupBy(DONOR, "Purpose", "ID")
        .agg(F.sum("Amount").cast(TOTAL).alias("Donated"))
    )
    titles = reduce(
        DataFrame.unionByName,
        [
            table.select(F.lit(name).alias("Purpose"), F.col(key).alias("ID"), "Title")
            for name, (key, table) in purposes.items()
        ],
    )
    titled = per_id.join(titles, ["Purpose", "ID"])
    donated = F.sum("Donated").alias("Donated")
    if not ignore_case:
        return titled.groupBy(DONOR, "Purpose", "Title").agg(donated)
    shared = comparable(F.col("Title"), ignore_case).alias("Shared")
    return titled.groupBy(DONOR, "Purpose", shared).agg(F.min("Title").alias("Title"), donated)


def gift_labels(
    donations: DataFrame, purposes: Purposes, ignore_case: bool = False
) -> DataFrame:
    """One row per donor, one text column per purpose: ``Title ($Sum)`` in text order."""
    label = F.concat(F.col("Title"), F.lit(" ($"), F.expr(two_decimals("Donated")), F.lit(")"))
    labels = title_totals(donations, purposes, ignore_case).withColumn("Label", label)
    for name in purposes:
        labels = labels.withColumn(name, F.when(F.col("Purpose") == name, F.col("Label")))
    return labels.groupBy(DONOR).agg(*[sorted_join(f"`{n}`", SEPARATOR).alias(n) for n in purposes])


def gift_purposes(tables: DonorTables) -> Purposes:
    return {
        "Campaigns": ("DonationCampaignID", tables.campaigns),
        "Funds": ("FundID", tables.funds),
        "Appeals": ("DonationAppealID", tables.appeals),
    }


def giving_levels(levels: DataFrame, params: ExportParams) -> DataFrame:
    """One row per form with active levels: the levels by amount, without and with titles.

    A form in the parameters limits the rows to it. A form's levels are one text, as long as it has
    levels; nothing is brought together beyond one form.
    """
    active = levels.filter(F.col("Active") & F.col("DonationTemplateID").isNotNull())
    if params.giving_template_id is not None:
        active = active.filter(F.col("DonationTemplateID") == F.lit(params.giving_template_id))
    amount = F.expr(two_decimals("Amount"))
    labelled = active.select(
        "DonationTemplateID",
        "Amount",
        F.concat(F.lit("$"), amount, F.lit("|")).alias("Plain"),
        F.concat(F.col("Title"), F.lit(":"), amount, F.lit(" | ")).alias("Titled"),
    )
    return labelled.groupBy("DonationTemplateID").agg(
        F.expr("listagg(Plain, '') WITHIN GROUP (ORDER BY Amount, Plain)").alias("GivingLevels"),
        F.expr("listagg(Titled, '') WITHIN GROUP (ORDER BY Amount, Titled)").alias(
            "GivingLevelsWithTitles"
        ),
    )
