"""Gold layer: the employee-grain analysis frame and the marts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from crewgauge import schemas
from crewgauge.functions import bands, dates, scores
from crewgauge.functions.numeric import HOUR_PLACES, exact_sum, percent, ratio, real, whole_units
from crewgauge.operators.headcount import monthly_movement
from crewgauge.operators.segments import by_segments
from crewgauge.params import Params
from crewgauge.plans import silver
from crewgauge.sinks.tables import stored
from crewgauge.sources.bronze import Bronze


# --- employee grain ---------------------------------------------------------------------------


def absence_per_employee(spells: DataFrame) -> DataFrame:
    """Totals per employee; each task sums its share first, so one busy employee is no hot spot."""
    return spells.groupBy("employee_key").agg(
        exact_sum(F.col("absence_hours"), HOUR_PLACES).alias("absence_hours"),
        F.sum("absence_days").alias("absence_days"),
        F.count("*").alias("absence_spells"),
    )


def with_measures(base: DataFrame, absence: DataFrame, params: Params) -> DataFrame:
    """Add exposure, absence and quality-of-hire columns to employee rows."""
    exposure, spells = F.col("exposure_days"), F.col("absence_spells")
    nothing = {"absence_hours": real(0), "absence_days": F.lit(0), "absence_spells": F.lit(0)}
    rows = (
        base.withColumn("exposure_days", scores.exposure_days(F.col("hire_date"), params))
        .join(absence, "employee_key", "left")
        .withColumns({c: F.coalesce(F.col(c), default) for c, default in nothing.items()})
        .withColumns({
            "scheduled_hours": scores.scheduled_hours(exposure, params),
            "absenteeism_rate_pct": scores.absenteeism_rate(F.col("absence_hours"), exposure, params),
            "bradford_factor": scores.bradford_factor(spells, F.col("absence_days")),
            "performance_score": scores.performance_score(F.col("performance_rating")),
            "retention_score": scores.retention_score(
                F.col("tenure_days"), F.col("is_active"), params.early_tenure_days
            ),
            "ramp_score": scores.ramp_score(F.col("ramp_up_days")),
            "hm_satisfaction_score": scores.manager_score(F.col("hiring_manager_satisfaction")),
        })
        .withColumn(
            "quality_of_hire",
            scores.quality_of_hire(
                F.col("performance_score"),
                F.col("ramp_score"),
                F.col("hm_satisfaction_score"),
                F.col("retention_score"),
            ),
        )
    )
    return rows.to(schemas.EMPLOYEE_ANALYSIS)


def employee_analysis(bronze: Bronze, params: Params) -> DataFrame:
    """The analysis frame straight from bronze.

    Same rows as the star join: an employee needs a department, a role and a recruitment row.
    The names are at hand here, so no surrogate key is looked up, and employees are shuffled
    once. Columns a mart does not use are never computed, and a mart without absence columns
    does not read absences at all.
    """
    base = _employment(bronze, params)
    return with_measures(base, absence_per_employee(silver.spells(bronze.spells)), params)


def _employment(bronze: Bronze, params: Params) -> DataFrame:
    rows = silver.employment(silver.hired_rows(bronze, params), params)
    return rows.where("department_name IS NOT NULL AND job_role_name IS NOT NULL")


def employee_analysis_from_star(star: silver.Star, params: Params) -> DataFrame:
    """The analysis frame from stored silver tables: fact_employment joined to its four partners.

    Tables bucketed on employee_key (see ``sinks.tables``) join here without a shuffle, and the
    stored size of the two name dimensions decides whether they are broadcast.
    """
    attributes = star.dim_employee.drop("department_key", "job_role_key", "performance_rating")
    hires = star.fact_recruitment.drop("recruitment_key", "hire_date", "hire_month_key", "req_open_date")
    base = (
        star.fact_employment.join(attributes, "employee_key")
        .join(hires, "employee_key")
        .join(star.dim_department, "department_key")
        .join(star.dim_job_role, "job_role_key")
    )
    return with_measures(base, absence_per_employee(star.fact_absence), params)


# --- segment marts ----------------------------------------------------------------------------


def separations_in_window(params: Params) -> Column:
    """The leaver flag, restricted to the trailing window if one is set."""
    flag = F.col("attrition_flag")
    if params.turnover_window_days is None:
        return flag
    start = F.date_sub(dates.date_lit(params.as_of), params.turnover_window_days)
    return F.when(F.col("termination_date") > start, flag).otherwise(F.lit(0))


def turnover_totals(params: Params) -> dict[str, Column]:
    return {"headcount_current": F.sum("is_active"), "separations": F.sum(separations_in_window(params))}


def average_heads() -> Column:
    return F.col("headcount_current") + F.col("separations") / real(2)


def turnover_pct() -> Column:
    return percent(F.col("separations"), average_heads(), 1)


def absence_totals() -> dict[str, Column]:
    """Whole units: a sum of doubles would depend on the order of arrival."""
    return {
        "employees": F.count("*"),
        "hour_units": whole_units(F.col("absence_hours"), HOUR_PLACES),
        "scheduled_tenths": whole_units(F.col("scheduled_hours"), 1),
        "days": F.sum("absence_days"),
    }


def absence_figures() -> dict[str, Column]:
    """Hours, scheduled hours, rate and days a head over columns of ``absence_totals``."""
    hours, scheduled = F.col("hour_units") / real(10**HOUR_PLACES), F.col("scheduled_tenths") / real(10)
    return {
        "absence_hours": F.round(hours, 0),
        "scheduled_hours": F.round(scheduled, 0),
        "absenteeism_rate_pct": percent(hours, scheduled, 2),
        "avg_absence_days": F.round(ratio(F.col("days"), F.col("employees")), 2),
    }


def kpi_turnover(analysis: DataFrame, params: Params = Params()) -> DataFrame:
    heads, seps = F.col("headcount_current"), F.col("separations")
    average = average_heads()
    segments = {
        "Department": F.col("department_name"),
        "Job role": F.col("job_role_name"),
        "Tenure band": F.col("tenure_band"),
        "Age band": F.col("age_band"),
        "Overtime": bands.overtime_label(F.col("overtime")),
    }
    return by_segments(analysis, segments, turnover_totals(params), ("Overall", "All employees")).select(
        "segment_type",
        "segment",
        heads,
        seps,
        F.round(average, 1).alias("avg_headcount"),
        turnover_pct().alias("turnover_pct"),
    )


def kpi_absenteeism(analysis: DataFrame) -> DataFrame:
    segments = {
        "Department": F.col("department_name"),
        "Overtime": bands.overtime_label(F.col("overtime")),
        "Work-life balance": bands.prefixed("WLB rating ", F.col("work_life_balance")),
    }
    return by_segments(analysis, segments, absence_totals(), ("Overall", "All employees")).select(
        "segment_type", "segment", "employees", *(figure.alias(name) for name, figure in absence_figures().items())
    )


# Measure -> (source column, decimals stored in it, decimals reported).
HIRE_AVERAGES = {
    "quality_of_hire": ("quality_of_hire", 1, 1),
    "performance_score": ("performance_score", 1, 1),
    "retention_score": ("retention_score", 1, 1),
    "ramp_score": ("ramp_score", 1, 1),
    "hm_satisfaction_score": ("hm_satisfaction_score", 1, 1),
    "avg_time_to_fill": ("time_to_fill_days", 0, 0),
    "avg_recruiting_cost": ("recruiting_cost", 0, 0),
}


def hire_totals(*names: str) -> dict[str, Column]:
    """Sum and count behind each named average; they add up over groups."""
    totals = {}
    for name in names:
        column, stored, _ = HIRE_AVERAGES[name]
        totals[f"{name}_sum"] = whole_units(F.col(column), stored)
        totals[f"{name}_n"] = F.count(column)
    return totals


def hire_average(name: str) -> Column:
    """The reported average over columns of ``hire_totals``. A score that is NULL for a person is left out of it."""
    _, stored, reported = HIRE_AVERAGES[name]
    return F.round(ratio(F.col(f"{name}_sum") / real(10**stored), F.col(f"{name}_n")), reported)


def kpi_quality_of_hire(analysis: DataFrame) -> DataFrame:
    """Averages by source channel."""
    segments = {"Source channel": F.col("source_channel")}
    totals = {"hires": F.count("*"), **hire_totals(*HIRE_AVERAGES)}
    return by_segments(analysis, segments, totals, ("Overall", "All hires")).select(
        "segment_type", "segment", "hires", *(hire_average(name).alias(name) for name in HIRE_AVERAGES)
    )


def drivers() -> dict[str, Column]:
    """Display name -> level label of the eight attrition drivers."""
    return {
        "Job satisfaction": bands.prefixed("Level ", F.col("job_satisfaction")),
        "Environment satisfaction": bands.prefixed("Level ", F.col("environment_satisfaction")),
        "Work-life balance": bands.prefixed("Level ", F.col("work_life_balance")),
        "Job involvement": bands.prefixed("Level ", F.col("job_involvement")),
        "Overtime": bands.overtime_label(F.col("overtime")),
        "Business travel": F.col("business_travel"),
        "Marital status": F.col("marital_status"),
        "Stock option level": bands.prefixed("Level ", F.col("stock_option_level")),
    }


def attrition_drivers(analysis: DataFrame) -> DataFrame:
    totals = {"headcount": F.count("*"), "leavers": F.sum("attrition_flag")}
    return by_segments(analysis, drivers(), totals, type_name="driver", label_name="level").withColumn(
        "attrition_pct", percent(F.col("leavers"), F.col("headcount"), 1)
    )


# --- absence and headcount marts --------------------------------------------------------------


def absence_by_reason(spells: DataFrame) -> DataFrame:
    """Spells and hours per reason with the share of all hours.

    One lazy plan: the sums per reason are grouped once more by reason and by nothing, and the reasons are joined with the one row of
    the total. No window, so the number of distinct reasons may grow without meeting in one task.
    """
    units = whole_units(F.col("absence_hours"), HOUR_PLACES).alias("units")
    sums = spells.groupBy("reason_code").agg(F.count("*").alias("spells"), units)
    both = sums.groupingSets([[F.col("reason_code")], []], "reason_code").agg(
        F.grouping_id().alias("total"), F.sum("spells").alias("spells"), F.sum("units").alias("units")
    )
    scale = real(10**HOUR_PLACES)
    # With the same columns as the reasons, so that both read one shuffle of the sums.
    whole = both.where("total = 1").select((F.col("units") / scale).alias("all_hours"), F.col("spells").alias("all_spells"))
    reasons = both.where("total = 0").withColumn("hours", F.col("units") / scale)
    return reasons.join(F.broadcast(whole)).select(
        "reason_code",
        "spells",
        F.round("hours", 0).alias("absence_hours"),
        F.when(F.col("all_spells") > 0, percent(F.col("hours"), F.col("all_hours"), 1)).alias("pct_of_hours"),
    )


def absence_monthly(spells: DataFrame, calendar: DataFrame) -> DataFrame:
    """Spells and hours per calendar month; months without a spell have no row.

    Months are added up before they meet the calendar, which has at most one row per month of
    the date type and is broadcast for that reason.
    """
    months = spells.groupBy(F.col("absence_month_key").alias("date_key")).agg(
        F.count("*").alias("spells"), F.round(exact_sum(F.col("absence_hours"), HOUR_PLACES), 0).alias("absence_hours")
    )
    return months.join(F.broadcast(calendar), "date_key").select(
        "date_key", "month_start", "year", "month_name", "spells", "absence_hours"
    )


def headcount_monthly(spans: DataFrame, calendar: DataFrame, params: Params) -> DataFrame:
    """Active heads, hires, separations and turnover for the trailing months."""
    first = dates.first_trailing_month(params.as_of, params.trailing_months)
    return (
        monthly_movement(spans, calendar)
        .where(F.col("date_key") >= first)
        .select(
            "date_key",
            "month_start",
            "year",
            "month_name",
            "active_headcount",
            "hires",
            "separations",
            percent(F.col("separations"), F.col("active_headcount"), 2).alias("monthly_turnover_pct"),
        )
    )


def employment_spans(bronze: Bronze, params: Params) -> DataFrame:
    """Hire and leaving months of everyone in fact_employment, straight from bronze."""
    return _employment(bronze, params).select("employee_key", "hire_month_key", "term_month_key")


def attrition_by_department(employment: DataFrame, departments: DataFrame, people: DataFrame) -> DataFrame:
    """Check of a finished star: attrition per department through both of its joins."""
    return (
        employment.join(people.select("employee_key"), "employee_key")
        .join(departments, "department_key")
        .groupBy("department_name")
        .agg(
            F.count("*").alias("headcount"),
            F.sum("attrition_flag").alias("leavers"),
            F.round(F.avg("attrition_flag") * real(100), 1).alias("attrition_pct"),
        )
    )


# The row order in which reports expect four of the marts.
MART_ORDER = {
    "absence_by_reason": ("-absence_hours", "reason_code"),
    "absence_monthly": ("date_key",),
    "kpi_quality_of_hire": ("segment_type", "-quality_of_hire", "segment"),
    "attrition_drivers": ("driver", "level"),
}


def ordered_mart(name: str, mart: DataFrame) -> DataFrame:
    """The mart in its report order, names after the ordering figures; other marts are left as they are."""
    keys = [F.col(k[1:]).desc_nulls_last() if k.startswith("-") else F.col(k).asc_nulls_first() for k in MART_ORDER.get(name, ())]
    return mart.orderBy(*keys) if keys else mart
