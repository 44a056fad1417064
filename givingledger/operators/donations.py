"""Row-level work on donations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from givingledger.functions.fiscal import FiscalCalendar, FiscalWindow
from givingledger.functions.money import TOTAL, currency, valued_amount
from givingledger.params import ExportParams


def valued_donations(donations: DataFrame) -> DataFrame:
    return donations.withColumn("ValuedAmount", valued_amount())


def donations_in_window(donations: DataFrame, window: FiscalWindow) -> DataFrame:
    """Both ends count; they are literals, so the filter reaches the file scan."""
    return donations.filter(window.covers("DonatedOn"))


def window_activity(donations: DataFrame, calendar: FiscalCalendar) -> DataFrame:
    """All fiscal windows with bounds and label, and what was given in each; 0 where nothing was."""
    tagged = donations.select(
        calendar.years_back("DonatedOn").alias("YearsBack"), "Amount"
    ).filter(F.col("YearsBack").isNotNull())
    totals = tagged.groupBy("YearsBack").agg(
        F.count(F.lit(1)).alias("Gifts"), F.sum("Amount").alias("Donated")
    )
    number = F.col("YearsBack")
    described = [
        F.element_at(F.array(*[F.lit(value) for value in column]), number + 1)
        for column in zip(
            *[(str(w.start), str(w.end), w.label) for w in calendar.windows], strict=True
        )
    ]
    count = len(calendar.windows)
    windows = donations.sparkSession.range(count).select(F.col("id").cast("int").alias("YearsBack"))
    return windows.join(totals, "YearsBack", "left").select(
        "YearsBack",
        described[0].cast("timestamp_ntz").alias("WindowStart"),
        described[1].cast("timestamp_ntz").alias("WindowEnd"),
        described[2].alias("Label"),
        F.coalesce("Gifts", F.lit(0)).alias("Gifts"),
        F.coalesce("Donated", F.lit(0)).cast(TOTAL).alias("Donated"),
    )


def year_to_date_total(donations: DataFrame, params: ExportParams) -> DataFrame:
    """One row: what *all* donors gave in the current fiscal year."""
    current = donations_in_window(donations, params.calendar.current)
    total = F.coalesce(F.sum(valued_amount()), F.lit(0)).cast(TOTAL)
    return current.agg(total.alias("DonatedYearToDate")).withColumn(
        "DonatedYearToDateFormatted", F.expr(currency("DonatedYearToDate"))
    )
