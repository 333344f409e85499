"""Every knob of the suite in one place; the defaults are the production values."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, timedelta


@dataclass(frozen=True)
class Params:
    """Run parameters.

    ``as_of`` plays the part of "today": no query looks at the wall clock, so
    a run can be repeated for any past day and gives the same rows. Rows later
    than ``as_of`` do not exist for a run.
    """

    as_of: date
    report_days: int = 30
    kpi_days: int = 7
    min_views: int = 10
    min_sent_exclusive: int = 5
    min_country_users: int = 250
    iqr_a: float = 2.0
    neighbour_slots: int = 3
    slot_minutes: int = 15
    reference_days: tuple[int, ...] = (0, 1, 7, 8, 14, 15)
    smooth_rows: int = 5
    chart_rows: int = 96
    backfill_rows: int = 101

    def __post_init__(self) -> None:
        if 24 * 60 % self.slot_minutes:
            raise ValueError("slot_minutes must divide a day")
        if self.smooth_rows % 2 == 0:
            raise ValueError("smooth_rows must be odd, the mean is centred")

    def day(self, days_back: int) -> date:
        return self.as_of - timedelta(days=days_back)

    @property
    def yesterday(self) -> date:
        return self.day(1)

    @property
    def slots_per_day(self) -> int:
        return 24 * 60 // self.slot_minutes

    @property
    def alert_days(self) -> list[date]:
        """The days an alert run loads, oldest first."""
        return sorted(self.day(back) for back in self.reference_days)
