"""Campaign progress, peer averages and labels on hand-made donors."""

from __future__ import annotations

import random
from datetime import datetime
from decimal import Decimal

import pytest
from fixtures import frame, gift, make_tables, params

from givingledger.names import ALL_DONOR_AVERAGE, NIL_GUID, TOP_DONOR_AVERAGE
from givingledger.operators.campaign import campaign_columns, campaign_summary
from givingledger.operators.labels import gift_labels, gift_purposes, giving_levels
from givingledger.operators.peers import peer_averages, top_average_sentence

LAST_YEAR = datetime(2022, 9, 1)


def peers(spark, amounts, **changes):
    gifts = [gift(amount, LAST_YEAR) for amount in amounts]
    return peer_averages(frame(spark, "donations", gifts), params(**changes)).first().asDict()


def rounded(row):
    return row[ALL_DONOR_AVERAGE], row[TOP_DONOR_AVERAGE]


def test_top_half(spark):
    row = peers(spark, [10, 20, 30, 40], top_percent=50)
    assert (row["Take"], row["TopDonated"]) == (2, 70)
    assert rounded(row) == (30, 40)


@pytest.mark.parametrize("percent", [10, 0, None, 150, -5])
def test_no_usable_percentage_takes_all(spark, percent):
    row = peers(spark, [10, 20, 30, 40], top_percent=percent)
    assert row["Take"] == 4
    assert rounded(row) == (30, 30)


def test_gifts_without_amount_count(spark):
    row = peers(spark, [10, None], top_percent=50)
    assert rounded(row) == (10, 10)
    assert rounded(peers(spark, [None, None], top_percent=50)) == (0, 0)
    assert rounded(peers(spark, [10, None], top_percent=100)) == (10, 10)


def test_no_gifts_last_year(spark):
    assert rounded(peers(spark, [], top_percent=50)) == (None, None)


def test_largest_amounts_against_sorting(spark):
    draw = random.Random(3)
    sizes = (1, 9, 10, 999_999, 10**6, 9 * 10**10)
    amounts = [
        Decimal(draw.randint(-10_000, 10_000) * size) / draw.choice((1, 100, 10_000))
        for size in sizes
        for _ in range(60)
    ]
    amounts += [Decimal("25.0000")] * 80 + [None] * 15
    draw.shuffle(amounts)
    for percent in (1, 10, 37, 50, 90, 99, 100):
        row = peers(spark, amounts, top_percent=percent)
        take = len(amounts) * percent // 100
        largest = sorted((a for a in amounts if a is not None), reverse=True)[:take]
        assert row["Take"] == take
        assert row["TopDonated"] == sum(largest).quantize(Decimal("0.0001"))


def test_averages_of_one_campaign(spark):
    gifts = [
        gift(100, LAST_YEAR, DonationCampaignID="c1"),
        gift(900, LAST_YEAR, DonationCampaignID="c2"),
    ]
    donations = frame(spark, "donations", gifts)

    def average(campaign):
        run = params(average_campaign_id=campaign)
        return peer_averages(donations, run).first()[ALL_DONOR_AVERAGE]

    assert average("C1") == 100
    assert average(None) == average(NIL_GUID) == 500


def test_sentence(spark):
    gifts = frame(spark, "donations", [gift(25, LAST_YEAR)])

    def sentence(donations, **changes):
        run = params(**changes)
        return peer_averages(donations, run).select(top_average_sentence(run)).first()[0]

    assert sentence(gifts) == ""
    assert sentence(gifts, include_top_average_sentence=True).startswith(
        "Last year, our top contributors gave on average 30Please consider a gift"
    )
    assert sentence(gifts.limit(0), include_top_average_sentence=True) == ""


CAMPAIGN = {"DonationCampaignID": "c", "Title": "Gala", "GoalAmount": 1000.0}


def campaign_row(spark, gifts, campaigns, **changes):
    run = params(**({"campaign_id": "C", "base_url": "https://x"} | changes))
    tables = make_tables(spark, campaigns=campaigns, donations=gifts)
    summary = campaign_summary(tables.campaigns, tables.donations, run)
    columns = campaign_columns(run)
    return summary.select(*[c.alias(n) for n, c in columns.items()]).first().asDict()


def labels(spark, gifts, **rows):
    tables = make_tables(spark, donations=gifts, **rows)
    (row,) = gift_labels(tables.donations, gift_purposes(tables)).collect()
    return row.asDict()


def test_goal_exceeded(spark):
    gifts = [gift("1250.50", None, DonationCampaignID="c")]
    row = campaign_row(spark, gifts, [CAMPAIGN])
    assert row["DonationCampaignTitle"] == "Gala"
    assert row["DonationCampaignGoalFromTemplate"] == "$1,000"
    assert row["DonationCampaignRaisedFromTemplate"] == "$1,251"
    assert row["DonationCampaignRemainingFromTemplate"] == "-$251"
    assert row["DonationCampaignPercentToGoalFromTemplate"] == "125%"
    assert row["UrlToDonationForm"] == "https://x/forms/donation/Gala"
    assert (
        row["LinkToDonationForm"]
        == '<a href="https://x/forms/donation/Gala" target="_blank">Donate Here</a>'
    )


def test_goal_zero_or_campaign_unknown(spark):
    row = campaign_row(spark, [], [CAMPAIGN | {"GoalAmount": 0.0}])
    assert row["DonationCampaignPercentToGoalFromTemplate"] == "0%"
    row = campaign_row(spark, [], [])
    assert row["DonationCampaignPercentToGoalFromTemplate"] == "0%"
    assert row["DonationCampaignRaisedFromTemplate"] == "$0"
    for name in (
        "DonationCampaignTitle",
        "DonationCampaignGoalFromTemplate",
        "DonationCampaignRemainingFromTemplate",
        "UrlToDonationForm",
        "LinkToDonationForm",
    ):
        assert row[name] is None, name


def test_rounding_of_whole_dollars(spark):
    gifts = [gift("2.50", None, DonationCampaignID="c")]
    row = campaign_row(spark, gifts, [CAMPAIGN | {"GoalAmount": 2.1}])
    assert row["DonationCampaignRaisedFromTemplate"] == "$3"
    assert row["DonationCampaignRemainingFromTemplate"] == "$0"


def test_long_texts_stay_whole(spark):
    title = "t" * 120
    row = campaign_row(spark, [], [CAMPAIGN | {"Title": title}], base_url="u" * 200)
    assert row["DonationCampaignTitle"] == title
    assert row["UrlToDonationForm"] == "u" * 200 + "/forms/donation/" + title
    assert row["UrlToDonationForm"] in row["LinkToDonationForm"]
    assert params(school_name="s" * 101).school_name == "s" * 101


def test_equal_titles_add_up(spark):
    campaigns = [CAMPAIGN, CAMPAIGN | {"DonationCampaignID": "c2"}]
    gifts = [gift(5, DonationCampaignID="c"), gift(7, DonationCampaignID="c2")]
    assert labels(spark, gifts, campaigns=campaigns)["Campaigns"] == "Gala ($12.00)"


def test_titles_may_ignore_case(spark):
    gifts = [gift(5, FundID="f1"), gift(7, FundID="f2"), gift(1, FundID="f3")]
    funds = [
        {"FundID": "f1", "Title": "roof"},
        {"FundID": "f2", "Title": "Roof "},
        {"FundID": "f3", "Title": "Books"},
    ]
    tables = make_tables(spark, donations=gifts, funds=funds)
    purposes = {"Funds": ("FundID", tables.funds)}
    exact = gift_labels(tables.donations, purposes).first()
    assert exact.Funds == "Books ($1.00), Roof  ($7.00), roof ($5.00)"
    folded = gift_labels(tables.donations, purposes, ignore_case=True).first()
    assert folded.Funds == "Books ($1.00), Roof  ($12.00)"


def test_labels_are_sorted_and_skip_unknown_titles(spark):
    gifts = [
        gift(1, FundID="f1", DonationAppealID="p"),
        gift("2.005", FundID="f2"),
        gift(3, FundID="f3"),
        gift(4, FundID="none"),
        gift(None, FundID="f4"),
    ]
    funds = [
        {"FundID": "f1", "Title": "Roof"},
        {"FundID": "f2", "Title": "Books"},
        {"FundID": "f3", "Title": None},
        {"FundID": "f4", "Title": "Art"},
    ]
    row = labels(spark, gifts, funds=funds, appeals=[{"DonationAppealID": "p"}])
    assert row["Funds"] == "Books ($2.01), Roof ($1.00)"
    assert row["Appeals"] is None
    assert row["Campaigns"] is None


def level(amount, title, active=True, form="t"):
    return {
        "DonationTemplateID": form,
        "Amount": Decimal(amount),
        "Title": title,
        "Active": active,
    }


def test_giving_levels(spark):
    levels = [
        level(100, None),
        level(25, "Friend"),
        level(1, "off", False),
        level(2, "x", True, "u"),
    ]
    row = giving_levels(frame(spark, "giving_levels", levels), params(giving_template_id="T"))
    assert row.first().asDict() == {
        "DonationTemplateID": "t",
        "GivingLevels": "$25.00|$100.00|",
        "GivingLevelsWithTitles": "Friend:25.00 | ",
    }
    empty = giving_levels(frame(spark, "giving_levels", []), params(giving_template_id="T"))
    assert empty.collect() == []
    forms = giving_levels(frame(spark, "giving_levels", levels), params())
    assert sorted(row.DonationTemplateID for row in forms.collect()) == ["t", "u"]


def test_many_giving_levels_stay_whole(spark):
    levels = [level(n % 10, "") for n in range(300)]
    (row,) = giving_levels(
        frame(spark, "giving_levels", levels), params(giving_template_id="t")
    ).collect()
    amounts = sorted(n % 10 for n in range(300))
    assert row.GivingLevels == "".join(f"${a}.00|" for a in amounts)
    assert row.GivingLevelsWithTitles == "".join(f":{a}.00 | " for a in amounts)


def test_donor_key_type_is_free(spark):
    """Donors may be told apart by integers as well."""
    donations = frame(spark, "donations", [gift(5, FundID="f")]).selectExpr(
        "7 AS DonorProfileID", "Amount", "FundID"
    )
    funds = frame(spark, "funds", [{"FundID": "f", "Title": "Roof"}])
    assert gift_labels(donations, {"Funds": ("FundID", funds)}).collect() == [(7, "Roof ($5.00)")]
