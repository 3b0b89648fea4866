"""Per-employee measures: exposure, absenteeism and the quality-of-hire components."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from crewgauge.functions.dates import date_lit
from crewgauge.functions.numeric import clamp01, ratio, real, smaller
from crewgauge.params import Params

# Scale ends (worst, best) of the scored components.
PERFORMANCE_SCALE = (1, 4)
MANAGER_SCALE = (1, 5)
RAMP_DAYS_SCALE = (180, 30)


def exposure_days(hired: Column, params: Params) -> Column:
    """Days of the absence window that fall after the hire. Leaving early does not shorten it."""
    served = F.datediff(date_lit(params.as_of), hired).cast("double")
    return smaller(real(params.absence_window_days), served)


def scheduled_hours(exposure: Column, params: Params) -> Column:
    return F.round(exposure * real(params.hours_per_calendar_day), 1)


def absenteeism_rate(absence_hours: Column, exposure: Column, params: Params) -> Column:
    """Percent of the unrounded scheduled hours; NULL without exposure."""
    return F.round(
        ratio(real(100) * absence_hours, exposure * real(params.hours_per_calendar_day)), 2
    )


def bradford_factor(spells: Column, days: Column) -> Column:
    """Spells squared times days, in DOUBLE: the product of one busy employee exceeds a BIGINT."""
    return spells.cast("double") * spells * days


def scale_fraction(value: Column, ends: tuple[int, int]) -> Column:
    worst, best = ends
    return (value - worst) / real(best - worst)


def performance_score(rating: Column) -> Column:
    return F.round(real(100) * scale_fraction(rating, PERFORMANCE_SCALE), 1)


def manager_score(satisfaction: Column) -> Column:
    return F.round(real(100) * scale_fraction(satisfaction, MANAGER_SCALE), 1)


def ramp_score(days: Column) -> Column:
    return F.round(real(100) * clamp01(scale_fraction(days, RAMP_DAYS_SCALE)), 1)


def retention_score(tenure: Column, is_active: Column, horizon: int) -> Column:
    """100 past the horizon, 50 or 0 for earlier leavers, NULL for those it is too soon to judge."""
    return (
        F.when(tenure >= horizon, real(100))
        .when(is_active == 1, F.lit(None).cast("double"))
        .when(tenure >= horizon // 2, real(50))
        .otherwise(real(0))
    )


def quality_of_hire(performance: Column, ramp: Column, manager: Column, retention: Column) -> Column:
    """Mean of the components; a missing retention is left out, any other gap gives NULL."""
    total = performance + ramp + manager + F.coalesce(retention, real(0))
    parts = F.when(retention.isNull(), real(3)).otherwise(real(4))
    return F.round(total / parts, 1)
