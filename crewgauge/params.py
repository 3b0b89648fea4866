"""Business parameters of one snapshot."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

# Working pattern behind the scheduled-hours denominator.
HOURS_PER_DAY = 7.5
WORKING_DAYS_PER_MONTH = 21.67
DAYS_PER_MONTH = 30.44


@dataclass(frozen=True)
class Params:
    """Everything a build depends on besides its input tables."""

    as_of: date = date(2025, 12, 31)
    absence_window_days: int = 365
    # The published denominator is the 4-decimal figure, 5.3392.
    hours_per_calendar_day: float = round(HOURS_PER_DAY * WORKING_DAYS_PER_MONTH / DAYS_PER_MONTH, 4)
    early_tenure_days: int = 365
    trailing_months: int = 24
    # Leavers without a recorded date are placed in this many days before the snapshot ...
    termination_spread_days: int = 365
    # ... but never sooner than this after being hired.
    minimum_service_days: int = 14
    # When set, turnover counts only separations of the last so many days.
    turnover_window_days: int | None = None
