"""Gifts, windows and percent changes on hand-made donors."""

from __future__ import annotations

from datetime import datetime
from decimal import Decimal

import pytest
from fixtures import donor, export_row, export_rows, frame, gift, make_tables, params

from givingledger.functions import keys
from givingledger.functions.fiscal import FiscalCalendar
from givingledger.operators import giving
from givingledger.operators.donations import window_activity
from givingledger.plans.export import named


def day(year, month, day_of_month, hour=0):
    return datetime(year, month, day_of_month, hour)


def rollup_row(spark, gifts, run=None):
    """The giving columns of one donor, without the rest of the export."""
    run = run or params()
    donors = frame(spark, "donors", [donor()]).select("DonorProfileID")
    joined = giving.with_giving(donors, frame(spark, "donations", gifts), run)
    columns = giving.giving_columns(run)
    (row,) = joined.select(*named(columns)).collect()
    return row.asDict()


def test_donor_without_gifts(spark):
    row = export_row(spark, [])
    assert row["DonorStatus"] == "Never Donated"
    assert row["TotalYearsGiven"] == 0
    for name, value in row.items():
        if name.startswith("NumberOf"):
            assert value == 0, name
        if name.startswith("PercentChange"):
            assert value is None, name
    for name in (
        "LifetimeDonatedAmount",
        "AverageDonationAmount",
        "FirstDonationDate",
        "FirstDonationAmount",
        "LastDonationAmount",
        "LastDonationDate",
        "LargestDonationAmount",
        "LargestDonationDate",
        "Campaigns",
        "Funds",
        "Appeals",
    ):
        assert row[name] is None, name
    assert row["DonatedTwoYearsAgo"] == row["DonatedLastYear"] == 0
    assert row["DonatedNineYearsAgoFormatted"] == "$0.00"


def test_gift_at_fiscal_start(spark):
    row = rollup_row(spark, [gift(100, day(2023, 7, 1))])
    assert row["DonorStatus"] == "Lapsing"
    assert row["DonatedLastYear"] == 100
    assert row["NumberOfGiftsAndPledgesYearToDate"] == 1
    assert row["NumberOfStockDonationsYearToDate"] == 1
    assert row["NumberOfInKindDonationsYearToDate"] == 1
    assert row["PercentChangeFromLastFiscalYear"] == -100


def test_gift_late_on_the_last_day_is_in_no_window(spark):
    row = rollup_row(spark, [gift(50, day(2023, 6, 30, 10))])
    windows = [v for n, v in row.items() if n.startswith("Donated") and "Formatted" not in n]
    assert set(windows) == {0}
    assert row["LifetimeDonatedAmount"] == 50
    assert row["DonorStatus"] == "Lapsing"


def test_percent_is_cut_not_rounded(spark):
    row = rollup_row(spark, [gift(439, day(2023, 1, 1)), gift(339, day(2023, 8, 1))])
    assert row["PercentChangeFromLastFiscalYear"] == Decimal("29.4900")
    row = rollup_row(spark, [gift(239, day(2023, 1, 1)), gift(339, day(2023, 8, 1))])
    assert row["PercentChangeFromLastFiscalYear"] == Decimal("-29.4900")


def test_valued_against_plain_amounts(spark):
    in_kind = gift(0, day(2021, 9, 1), InKind=True, InKindFairMarketValue=Decimal(75))
    row = rollup_row(spark, [in_kind, gift(50, day(2020, 9, 1))])
    assert row["DonatedTwoYearsAgo"] == 0
    assert row["PercentChangeFromThreeFYAgoToTwoFYAgo"] == "50.00"
    assert row["PercentChangeFromTwoFYAgoToOneFYAgo"] is None


def test_valued_stock(spark):
    stock = gift(10, day(2020, 9, 1), IsStock=True, StockFairMarketValue=Decimal(30))
    row = rollup_row(spark, [stock])
    assert row["DonatedPreviousThreeYears"] == 30
    assert row["DonatedThreeYearsAgo"] == 10
    assert row["DonatedThreeYearsAgoFormatted"] == "$10.00"


def test_market_value_replaces_only_a_zero_amount(spark):
    priced = gift(5, day(2020, 9, 1), InKind=True, InKindFairMarketValue=Decimal(75))
    assert rollup_row(spark, [priced])["DonatedPreviousThreeYears"] == 5


def test_unknown_flags_count_nowhere(spark):
    row = rollup_row(spark, [gift(20, day(2023, 8, 1), IsStock=None, InKind=None)])
    assert [v for n, v in row.items() if n.startswith("NumberOf")] == [0] * 9
    assert row["LifetimeDonatedAmount"] == 20


def test_gift_without_date_comes_first(spark):
    row = rollup_row(spark, [gift(7), gift(9, day(2022, 1, 1))])
    assert (row["FirstDonationDate"], row["FirstDonationAmount"]) == (None, 7)
    assert (row["LastDonationDate"], row["LastDonationAmount"]) == (day(2022, 1, 1), 9)
    assert row["TotalYearsGiven"] == 1


def test_only_gift_has_no_date(spark):
    row = rollup_row(spark, [gift(7)])
    assert row["DonorStatus"] == "Former Donor"
    assert row["TotalYearsGiven"] == 0
    assert row["NumberOfGiftsAndPledgesLifetime"] == 0


def test_gift_without_amount(spark):
    row = rollup_row(spark, [gift(None, day(2022, 1, 1)), gift(9, day(2022, 1, 2))])
    assert row["FirstDonationAmount"] is None
    assert row["AverageDonationAmount"] == 9
    assert row["NumberOfGiftsAndPledgesLifetime"] == 2
    assert rollup_row(spark, [gift(None, day(2022, 1, 1))])["AverageDonationAmount"] is None


def test_gifts_of_the_same_moment_rank_by_amount(spark):
    same = [gift(amount, day(2022, 1, 1)) for amount in (5, 3, 8)]
    row = rollup_row(spark, same)
    assert (row["FirstDonationAmount"], row["LastDonationAmount"]) == (3, 8)


def test_largest_gift_date(spark):
    row = rollup_row(
        spark, [gift(8, day(2020, 1, 1)), gift(8, day(2021, 1, 1)), gift(1, day(2023, 1, 1))]
    )
    assert (row["LargestDonationAmount"], row["LargestDonationDate"]) == (8, day(2021, 1, 1))


@pytest.mark.parametrize(
    ("last", "status"),
    [
        (day(2030, 1, 1), "Current Donor"),
        (day(2023, 7, 1, 1), "Current Donor"),
        (day(2022, 7, 1, 1), "Lapsing"),
        (day(2022, 7, 1), "Lapsed"),
        (day(2020, 7, 1, 1), "Lapsed"),
        (day(2020, 7, 1), "Former Donor"),
    ],
)
def test_status_tiers(spark, last, status):
    assert rollup_row(spark, [gift(1, last), gift(1, day(2001, 1, 1))])["DonorStatus"] == status


def test_giving_years_of_an_october_start(spark):
    dates = [day(2023, 2, 1), day(2023, 4, 15), day(2023, 9, 30), day(2023, 10, 1)]
    run = params(fiscal_start=day(2023, 10, 1))
    gifts = [gift(1, date) for date in dates]
    assert rollup_row(spark, gifts, run)["TotalYearsGiven"] == 2
    years = frame(spark, "donations", gifts).select(run.calendar.giving_year("DonatedOn"))
    assert [row[0] for row in years.collect()] == [2023, 2024, 2024, 2023]


def test_years_count_once_across_windows(spark):
    # Calendar year 2022 spans two fiscal years and a gap at the end of June.
    dates = [day(2022, 1, 5), day(2022, 6, 30, 9), day(2022, 8, 1), day(2021, 3, 1)]
    assert rollup_row(spark, [gift(1, d) for d in dates])["TotalYearsGiven"] == 2


def test_negative_window_total(spark):
    row = rollup_row(spark, [gift("-12.345", day(2021, 9, 1))])
    assert row["DonatedTwoYearsAgoFormatted"] == "($12.35)"


def test_start_in_the_future_moves_back_once():
    as_of = day(2024, 1, 15)
    assert FiscalCalendar.starting(day(2024, 7, 1), as_of).start == day(2023, 7, 1)
    assert FiscalCalendar.starting(day(2026, 7, 1), as_of).start == day(2025, 7, 1)
    assert FiscalCalendar.starting(day(2024, 1, 15), as_of).start == day(2024, 1, 15)


def test_windows_around_leap_days():
    calendar = FiscalCalendar(day(2024, 2, 29))
    windows = calendar.windows
    assert windows[0].end == day(2025, 2, 27)
    assert (windows[1].start, windows[1].end) == (day(2023, 2, 28), day(2024, 2, 28))
    assert windows[4].start == day(2020, 2, 29)
    assert calendar.peer_window.end == day(2024, 2, 27)

    calendar = FiscalCalendar(day(2024, 3, 1))
    assert calendar.windows[1].end == day(2024, 2, 29)
    assert calendar.peer_window.end == day(2024, 2, 28)


def test_windows_do_not_overlap():
    for start in (day(2023, 7, 1), day(2024, 2, 29), day(2024, 3, 1), datetime(2023, 12, 31, 8)):
        windows = FiscalCalendar(start).windows
        for newer, older in zip(windows, windows[1:], strict=False):
            assert older.start < older.end < newer.start


def test_window_labels(spark):
    row = export_row(spark, [])
    assert row["FiscalYearToDate"] == "01-07-2023 - 30-06-2024"
    assert row["FiscalLastYear"] == "01-07-2022-30-06-2023"
    assert row["FiscalNineYearsAgo"] == "01-07-2014-30-06-2015"


def test_window_activity(spark):
    gifts = [gift(5, day(2023, 8, 1)), gift(6, day(2023, 8, 1)), gift(7, day(2023, 6, 30, 10))]
    found = window_activity(frame(spark, "donations", gifts), params().calendar).collect()
    row, *empty = sorted(found, key=lambda r: r.YearsBack)
    assert [(r.YearsBack, r.Gifts, r.Donated) for r in empty] == [(k, 0, 0) for k in range(1, 10)]
    assert row.asDict() == {
        "YearsBack": 0,
        "WindowStart": day(2023, 7, 1),
        "WindowEnd": day(2024, 6, 30),
        "Label": "01-07-2023 - 30-06-2024",
        "Gifts": 2,
        "Donated": 11,
    }


def test_total_of_all_donors(spark):
    gifts = [
        gift(5, day(2023, 8, 1)),
        gift(7, day(2023, 8, 1), key=None),
        gift(1, day(2023, 8, 1), key="not a donor"),
        gift(100, day(2022, 8, 1)),
    ]
    rows = export_rows(spark, params(), donors=[donor(), donor("e")], donations=gifts)
    assert {row["DonatedYearToDate"] for row in rows} == {13}
    assert {row["DonatedYearToDateFormatted"] for row in rows} == {"$13.00"}


def test_windows_never_exceed_lifetime(spark):
    gifts = [gift(n, day(2014 + n % 10, 1 + n % 12, 1 + n % 28)) for n in range(1, 80)]
    row = rollup_row(spark, gifts)
    windows = [v for n, v in row.items() if n.endswith("YearsAgo")]
    assert 0 < sum(windows) <= row["LifetimeDonatedAmount"]


def test_order_of_gifts_does_not_matter(spark):
    gifts = [gift(n % 7, day(2014 + n % 10, 1 + n % 12, 1)) for n in range(60)]
    tables = make_tables(spark, donors=[donor()], donations=gifts)
    run = params()

    def result(donations):
        joined = giving.with_giving(tables.donors, donations, run)
        return joined.select(*named(giving.giving_columns(run))).collect()

    assert result(tables.donations.repartition(5, "Amount")) == result(
        tables.donations.coalesce(1).orderBy("Amount", ascending=False)
    )


def test_keys_keep_pairs_and_their_order(spark):
    """Dates with times, before 1970, in a missing hour; unknown dates and amounts; extreme amounts."""
    dates = ["0001-01-01 00:00:00", "1969-12-31 23:59:59.999999", "2023-03-12 02:30:00.000001", "9999-12-31 23:59:59.5", None]
    amounts = ["-999999999999999.9999", "-0.0001", "0", "0.0001", "999999999999999.9999", None]
    pairs = spark.createDataFrame([(d, a) for d in dates for a in amounts], "d string, a string").selectExpr(
        "CAST(d AS timestamp_ntz) AS d", "CAST(a AS decimal(19,4)) AS a")
    by_date, by_amount = keys.date_amount_key("d", "a"), keys.amount_date_key("a", "d")
    rows = pairs.selectExpr("d", "a", f"{by_date} AS x", f"{by_amount} AS y").selectExpr(
        "d", "a", "x", "y", f"{keys.date_of_date_key('x')} AS dx", f"{keys.amount_of_date_key('x')} AS ax",
        f"{keys.date_of_amount_key('y')} AS dy").collect()
    assert len(rows) == 30
    assert all((r.dx, r.ax, r.dy) == (r.d, r.a, r.d) for r in rows)
    known_first = lambda value: (value is not None, value)
    assert sorted(rows, key=lambda r: r.x) == sorted(rows, key=lambda r: (known_first(r.d), known_first(r.a)))
    assert sorted(rows, key=lambda r: r.y) == sorted(rows, key=lambda r: (known_first(r.a), known_first(r.d)))
