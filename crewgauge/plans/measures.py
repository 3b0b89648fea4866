"""Reporting measures: named aggregates that work under any grouping and filter."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from crewgauge.functions.bands import turnover_status
from crewgauge.functions.numeric import HOUR_PLACES, exact_avg, exact_sum, ratio, real, whole_units


def _active() -> Column:
    return F.sum("is_active")


def _separations() -> Column:
    return F.sum("attrition_flag")


def _average_headcount() -> Column:
    return _active() + _separations() / real(2)


def _turnover() -> Column:
    return ratio(_separations(), _average_headcount())


def _absence_hours() -> Column:
    return exact_sum(F.col("absence_hours"), HOUR_PLACES)


def _attrition_rate() -> Column:
    return ratio(_separations(), F.count("*"))


# Over the analysis frame. Rates are fractions, as a report formats them itself.
MEASURES: dict[str, Callable[[], Column]] = {
    "headcount": lambda: F.count("*"),
    "active_headcount": _active,
    "separations": _separations,
    "average_headcount": _average_headcount,
    "turnover_rate": _turnover,
    "attrition_rate": _attrition_rate,
    "retention_rate": lambda: real(1) - _attrition_rate(),
    "absence_hours": _absence_hours,
    "scheduled_hours": lambda: exact_sum(F.col("scheduled_hours")),
    "absenteeism_rate": lambda: ratio(_absence_hours(), exact_sum(F.col("scheduled_hours"))),
    "avg_absence_days": lambda: F.avg("absence_days"),
    "avg_bradford_factor": lambda: F.avg("bradford_factor"),
    "quality_of_hire": lambda: exact_avg(F.col("quality_of_hire")),
    "qoh_performance": lambda: exact_avg(F.col("performance_score")),
    "qoh_retention": lambda: exact_avg(F.col("retention_score")),
    "qoh_ramp": lambda: exact_avg(F.col("ramp_score")),
    "qoh_hiring_manager": lambda: exact_avg(F.col("hm_satisfaction_score")),
    "avg_time_to_fill": lambda: F.avg("time_to_fill_days"),
    "avg_ramp_up_days": lambda: F.avg("ramp_up_days"),
    "recruiting_cost": lambda: F.sum("recruiting_cost"),
    "cost_per_hire": lambda: ratio(F.sum("recruiting_cost"), F.count("*")),
    "turnover_status": lambda: turnover_status(_turnover()),
}


def evaluate(
    analysis: DataFrame,
    names: Sequence[str] = tuple(MEASURES),
    by: Sequence[str | Column] = (),
    where: Column | str | None = None,
) -> DataFrame:
    """The named measures per group of ``by`` over the rows that pass ``where``."""
    unknown = [n for n in names if n not in MEASURES]
    if unknown:
        raise KeyError(f"unknown measures: {unknown}")
    rows = analysis if where is None else analysis.where(where)
    return rows.groupBy(*by).agg(*(MEASURES[n]().alias(n) for n in names))


def with_subtotals(
    analysis: DataFrame,
    names: Sequence[str] = tuple(MEASURES),
    by: Sequence[str] = (),
    where: Column | str | None = None,
    sets: Sequence[Sequence[str]] | None = None,
) -> DataFrame:
    """The named measures for each of several groupings of ``by``: every combination of its columns unless ``sets`` lists some.

    Averages and ratios do not add up, so each grouping is computed from the rows, all of them in one pass. ``grouping`` tells a subtotal
    from a level that is NULL: bit by bit, the first column highest, 1 where a column is totalled.
    """
    unknown = [n for n in names if n not in MEASURES]
    if unknown:
        raise KeyError(f"unknown measures: {unknown}")
    rows = analysis if where is None else analysis.where(where)
    measures = [F.grouping_id().cast("int").alias("grouping"), *(MEASURES[n]().alias(n) for n in names)]
    if sets is None:
        return rows.cube(*by).agg(*measures)
    return rows.groupingSets([[F.col(c) for c in s] for s in sets], *by).agg(*measures)


def absence_hours_trend(
    spells: DataFrame,
    calendar: DataFrame,
    people: DataFrame | None = None,
    by: Sequence[str] = (),
    where: Column | str | None = None,
    spells_where: Column | str | None = None,
) -> DataFrame:
    """Absence hours under each month of the calendar that has any, in the filter context of both facts.

    ``by`` and ``where`` name columns of ``people`` (one row per employee_key, as the analysis frame), ``spells_where`` those of the absences. Without ``by`` the
    filter reaches the absences as a left-semi join on the key; with it the levels have to come along, in one join on the same key.
    Either way hours are first added up by employee and month, so an employee with very many absences is a few rows in the join.
    """
    rows = spells if spells_where is None else spells.where(spells_where)
    month = F.col("absence_month_key").alias("date_key")
    if people is not None and (by or where is not None):
        some = (people if where is None else people.where(where)).select("employee_key", *by)
        units = whole_units(F.col("absence_hours"), HOUR_PLACES).alias("units")
        rows = rows.groupBy("employee_key", month).agg(units).join(some, "employee_key", "inner" if by else "left_semi")
        months = rows.groupBy("date_key", *by).agg((F.sum("units") / real(10**HOUR_PLACES)).alias("absence_hours"))
    else:
        months = rows.groupBy(month).agg(_absence_hours().alias("absence_hours"))
    return months.join(F.broadcast(calendar.select("date_key", "month_start")), "date_key")


def active_at(month_key: int | Column) -> Column:
    """Heads active in one month, as an aggregate over employment spans under any grouping."""
    hired, left = F.col("hire_month_key"), F.col("term_month_key")
    return F.count_if((hired <= month_key) & (left.isNull() | (left > month_key)))
