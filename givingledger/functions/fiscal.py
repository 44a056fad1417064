"""The ten fiscal years of an export, computed once on the driver and passed as literals."""

from __future__ import annotations

import calendar
from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

WINDOW_COUNT = 10
ONE_DAY = timedelta(days=1)


def timestamp(value: datetime) -> str:
    """A zone-less SQL literal: it means the same whatever the session time zone is."""
    return f"TIMESTAMP_NTZ '{value.isoformat(sep=' ')}'"


def shift_years(value: datetime, years: int) -> datetime:
    """Calendar-year arithmetic; 29 February becomes the 28th in common years."""
    year = value.year + years
    last_day = calendar.monthrange(year, value.month)[1]
    return value.replace(year=year, day=min(value.day, last_day))


def day_text(value: datetime) -> str:
    return f"{value.day:02d}-{value.month:02d}-{value.year:04d}"


@dataclass(frozen=True)
class FiscalWindow:
    """A closed range of timestamps. It ends at the *time of day of the start* on its last day."""

    years_back: int
    start: datetime
    end: datetime

    def covers(self, when: str) -> str:
        """SQL condition on the column ``when``."""
        return f"{when} BETWEEN {timestamp(self.start)} AND {timestamp(self.end)}"

    @property
    def label(self) -> str:
        separator = " - " if self.years_back == 0 else "-"
        return day_text(self.start) + separator + day_text(self.end)


@dataclass(frozen=True)
class FiscalCalendar:
    start: datetime

    @classmethod
    def starting(cls, fiscal_start: datetime, as_of: datetime) -> FiscalCalendar:
        """A start in the future moves back by one year, and only one."""
        return cls(shift_years(fiscal_start, -1) if fiscal_start > as_of else fiscal_start)

    @property
    def windows(self) -> tuple[FiscalWindow, ...]:
        starts = [shift_years(self.start, -back) for back in range(WINDOW_COUNT)]
        ends = [shift_years(self.start, 1) - ONE_DAY] + [start - ONE_DAY for start in starts[:-1]]
        return tuple(map(FiscalWindow, range(WINDOW_COUNT), starts, ends))

    @property
    def current(self) -> FiscalWindow:
        return self.windows[0]

    @property
    def peer_window(self) -> FiscalWindow:
        """Last year as the peer averages see it: both ends of this year moved back.

        Around leap days this is not the same range as ``windows[1]``.
        """
        current = self.current
        return FiscalWindow(1, shift_years(current.start, -1), shift_years(current.end, -1))

    def years_back(self, when: str) -> Column:
        """Number of the window a timestamp falls in, NULL for none (windows never overlap)."""
        cases = [f"WHEN {window.covers(when)} THEN {window.years_back}" for window in self.windows]
        return F.expr(f"CASE {' '.join(cases)} END")

    def giving_year(self, when: str) -> Column:
        """Year a gift counts for: months before the fiscal month are moved up by that offset."""
        month = self.start.month
        moved = F.timestamp_add("MONTH", F.lit(month - 1), when)
        return F.when(F.month(when) >= month, F.year(when)).otherwise(F.year(moved))
