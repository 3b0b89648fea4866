"""Star schema: four dimensions and three facts over the bronze frames."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from crewgauge import schemas
from crewgauge.functions import bands, dates
from crewgauge.operators.numbering import number_rows
from crewgauge.params import Params
from crewgauge.sources.bronze import Bronze

# Raw column -> target column, where the value is taken as it is.
EMPLOYEE_NAMES = {
    "EmployeeNumber": "employee_key",
    "Age": "age",
    "Gender": "gender",
    "MaritalStatus": "marital_status",
    "Education": "education",
    "EducationField": "education_field",
    "JobLevel": "job_level",
    "BusinessTravel": "business_travel",
    "DistanceFromHome": "distance_from_home",
    "NumCompaniesWorked": "num_companies_worked",
    "StockOptionLevel": "stock_option_level",
    "TrainingTimesLastYear": "training_times_last_year",
    "JobSatisfaction": "job_satisfaction",
    "EnvironmentSatisfaction": "environment_satisfaction",
    "RelationshipSatisfaction": "relationship_satisfaction",
    "WorkLifeBalance": "work_life_balance",
    "JobInvolvement": "job_involvement",
    "MonthlyIncome": "monthly_income",
    "PerformanceRating": "performance_rating",
    "PercentSalaryHike": "percent_salary_hike",
    "YearsInCurrentRole": "years_in_current_role",
    "YearsSinceLastPromotion": "years_since_last_promotion",
    "YearsWithCurrManager": "years_with_curr_manager",
}
RECRUITMENT_NAMES = {
    "EmployeeNumber": "employee_key",
    "SourceChannel": "source_channel",
    "ReqOpenDate": "req_open_date",
    "HireDate": "hire_date",
    "TimeToFillDays": "time_to_fill_days",
    "RampUpDays": "ramp_up_days",
    "HiringManagerSatisfaction": "hiring_manager_satisfaction",
    "RecruitingCost": "recruiting_cost",
}
ABSENCE_NAMES = {
    "AbsenceID": "absence_key",
    "EmployeeNumber": "employee_key",
    "AbsenceDate": "absence_date",
    "AbsenceHours": "absence_hours",
    "AbsenceDays": "absence_days",
    "ReasonCode": "reason_code",
}


def stage_employees(employees: DataFrame) -> DataFrame:
    """Target names, trimmed department and role, bands and flags."""
    left = bands.flag(F.col("Attrition") == "Yes")
    return employees.withColumns({
        "department_name": F.trim("Department"),
        "job_role_name": F.trim("JobRole"),
        "age_band": bands.band(F.col("Age"), bands.AGE_BANDS),
        "distance_band": bands.band(F.col("DistanceFromHome"), bands.DISTANCE_BANDS, inclusive=True),
        "income_band": bands.band(F.col("MonthlyIncome"), bands.INCOME_BANDS),
        "overtime_flag": bands.flag(F.col("OverTime") == "Yes"),
        "attrition_flag": left,
        "is_active": 1 - left,
    }).drop("OverTime").withColumnsRenamed({**EMPLOYEE_NAMES, "overtime_flag": "overtime"})


def stage_recruitment(recruitment: DataFrame) -> DataFrame:
    """Target names and the hire month. Columns already renamed stay as they are."""
    return recruitment.withColumn("hire_month_key", dates.month_key(F.col("HireDate"))).withColumnsRenamed(
        RECRUITMENT_NAMES
    )


def spells(absence: DataFrame) -> DataFrame:
    """Absence rows under their target names, with or without a key."""
    return absence.withColumn("absence_month_key", dates.month_key(F.col("AbsenceDate"))).withColumnsRenamed(
        ABSENCE_NAMES
    )


def name_dimension(employees: DataFrame, raw: str, key: str, name: str) -> DataFrame:
    """Distinct trimmed names with consecutive keys in name order; a missing name comes first.

    They are numbered in slices at every size. Spark's own size check decides whether a join to
    them is a broadcast; where it is not, adaptive execution splits the partitions of hot names.
    """
    names = employees.select(F.trim(raw).alias(name)).distinct()
    return number_rows(names, [name], key, distinct=True)


def dim_department(employees: DataFrame) -> DataFrame:
    return name_dimension(employees, "Department", "department_key", "department_name")


def dim_job_role(employees: DataFrame) -> DataFrame:
    return name_dimension(employees, "JobRole", "job_role_key", "job_role_name")


def dim_date(hire_dates: DataFrame, as_of: date) -> DataFrame:
    """Every month from the earliest HireDate to the snapshot; at least the hire month."""
    bounds = hire_dates.agg(F.trunc(F.min("HireDate"), "MM").alias("low")).select(
        "low", F.greatest("low", F.trunc(dates.date_lit(as_of), "MM")).alias("high")
    )
    months = bounds.where("low IS NOT NULL").select(
        F.explode(F.sequence("low", "high", F.expr("interval 1 month"))).alias("month_start")
    )
    month = F.col("month_start")
    return months.select(
        dates.month_key(month).alias("date_key"),
        month,
        F.year(month).alias("year"),
        F.month(month).alias("month_num"),
        dates.month_name(month).alias("month_name"),
        dates.quarter_name(month).alias("quarter"),
    )


def with_keys(staged: DataFrame, departments: DataFrame, roles: DataFrame) -> DataFrame:
    """Resolve both names to keys. A NULL name matches nothing, so such employees drop out."""
    return staged.join(departments, "department_name").join(roles, "job_role_name")


def dim_employee(employees: DataFrame, departments: DataFrame, roles: DataFrame) -> DataFrame:
    return with_keys(stage_employees(employees), departments, roles).to(schemas.DIM_EMPLOYEE)


def join_hires(
    employees: DataFrame, recruitment: DataFrame, terminations: DataFrame | None, params: Params
) -> DataFrame:
    """Raw employees with their recruitment row and, for leavers, a leaving date.

    All sides hold one row per employee, so this is the one large join of the employment grain;
    everything after it is keyed the same way and needs no further shuffle of this side.
    """
    rows = employees.join(recruitment, "EmployeeNumber")
    if terminations is not None:
        return rows.join(terminations, "EmployeeNumber", "left")
    departure = _derived_departure(F.col("EmployeeNumber"), F.col("HireDate"), params)
    return rows.withColumn("termination_date", F.when(F.col("Attrition") == "Yes", departure))


def employment(hired: DataFrame, params: Params) -> DataFrame:
    """``join_hires`` rows under their target names, with tenure."""
    left = F.col("termination_date")
    days = dates.tenure_days(F.col("hire_date"), left, params.as_of)
    years = F.col("tenure_days") / F.lit(365.25)
    return (
        stage_recruitment(stage_employees(hired))
        .withColumns({"term_month_key": dates.month_key(left), "tenure_days": days})
        .withColumns({
            "tenure_years": F.round(years, 2),
            "tenure_band": bands.band(years, bands.TENURE_BANDS),
        })
    )


def derived_terminations(employees: DataFrame, recruitment: DataFrame, params: Params) -> DataFrame:
    """Stage frame of leavers. A leaver without a recruitment row has no date."""
    leavers = employees.where(F.col("Attrition") == "Yes").select("EmployeeNumber")
    hires = recruitment.select("EmployeeNumber", "HireDate")
    return leavers.join(hires, "EmployeeNumber", "left").select(
        "EmployeeNumber", _derived_departure(F.col("EmployeeNumber"), F.col("HireDate"), params).alias("termination_date")
    )


def _derived_departure(key: Column, hired: Column, params: Params) -> Column:
    return dates.hashed_departure(
        key, hired, params.as_of, params.termination_spread_days, params.minimum_service_days
    )


def fact_employment(hired: DataFrame, departments: DataFrame, roles: DataFrame, params: Params) -> DataFrame:
    return with_keys(employment(hired, params), departments, roles).to(schemas.FACT_EMPLOYMENT)


def fact_absence(absence: DataFrame) -> DataFrame:
    return spells(absence).to(schemas.FACT_ABSENCE)


def fact_recruitment(recruitment: DataFrame) -> DataFrame:
    """An employee has one recruitment row, so the employee number alone gives the order."""
    return number_rows(stage_recruitment(recruitment), ["employee_key"], "recruitment_key", distinct=True).to(
        schemas.FACT_RECRUITMENT
    )


@dataclass(frozen=True)
class Star:
    """The seven silver tables."""

    dim_department: DataFrame
    dim_job_role: DataFrame
    dim_date: DataFrame
    dim_employee: DataFrame
    fact_employment: DataFrame
    fact_absence: DataFrame
    fact_recruitment: DataFrame

    def tables(self) -> dict[str, DataFrame]:
        return dict(self.__dict__)


def hired_rows(bronze: Bronze, params: Params) -> DataFrame:
    return join_hires(bronze.employees, bronze.recruitment, bronze.terminations, params)


def build_star(bronze: Bronze, params: Params) -> Star:
    departments = dim_department(bronze.employees)
    roles = dim_job_role(bronze.employees)
    hired = hired_rows(bronze, params)
    return Star(
        dim_department=departments,
        dim_job_role=roles,
        dim_date=dim_date(bronze.hires, params.as_of),
        dim_employee=dim_employee(bronze.employees, departments, roles),
        fact_employment=fact_employment(hired, departments, roles, params),
        fact_absence=fact_absence(bronze.absence),
        fact_recruitment=fact_recruitment(bronze.recruitment),
    )
