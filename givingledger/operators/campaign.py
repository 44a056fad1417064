"""Progress of the campaign a letter asks for. Everything here is a single row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from givingledger.functions.money import whole_dollars
from givingledger.names import DONATION_FORM_PATH, LINK_CLOSE, LINK_OPEN
from givingledger.params import ExportParams


def campaign_summary(
    campaigns: DataFrame, donations: DataFrame, params: ExportParams
) -> DataFrame:
    """Title, goal, amount raised and percent to goal; a row also for an unknown campaign."""
    is_campaign = F.col("DonationCampaignID") == F.lit(params.campaign_id)
    chosen = (
        campaigns.filter(is_campaign)
        .agg(F.max(F.struct("Title", "GoalAmount")).alias("Campaign"))
        .select(
            F.col("Campaign.Title").alias("CampaignTitle"),
            F.col("Campaign.GoalAmount").alias("CampaignGoal"),
        )
    )
    raised = donations.filter(is_campaign).agg(
        F.coalesce(F.sum("Amount"), F.lit(0)).cast("double").alias("AmountRaised")
    )
    share = F.col("AmountRaised") / F.nullif(F.col("CampaignGoal"), F.lit(0.0)) * 100
    return chosen.crossJoin(F.broadcast(raised)).withColumn(
        "PercentToGoal", F.round(F.coalesce(share, F.lit(0.0)), 0)
    )


def donation_url(params: ExportParams) -> Column:
    """NULL if the base or the title is unknown."""
    base = F.lit(params.base_url).cast("string")
    return F.concat(base, F.lit(DONATION_FORM_PATH), F.col("CampaignTitle"))


def campaign_columns(params: ExportParams) -> dict[str, Column]:
    """Output columns over a row of :func:`campaign_summary`."""
    url = donation_url(params)
    return {
        "DonationCampaignTitle": F.col("CampaignTitle"),
        "DonationCampaignGoalFromTemplate": F.expr(whole_dollars("CampaignGoal")),
        "DonationCampaignRaisedFromTemplate": F.expr(whole_dollars("AmountRaised")),
        "DonationCampaignRemainingFromTemplate": F.expr(
            whole_dollars("CampaignGoal - AmountRaised")
        ),
        "DonationCampaignPercentToGoalFromTemplate": F.concat(
            F.col("PercentToGoal").cast("bigint").cast("string"), F.lit("%")
        ),
        "LinkToDonationForm": F.concat(F.lit(LINK_OPEN), url, F.lit(LINK_CLOSE)),
        "UrlToDonationForm": url,
    }
