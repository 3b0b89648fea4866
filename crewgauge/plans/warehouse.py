"""The stored build: bronze, silver and gold tables, each layer read back from the one before."""

from __future__ import annotations

from pyspark.sql import DataFrame

from crewgauge.params import Params
from crewgauge.plans import gold, silver
from crewgauge.plans.publish import publish_checked
from crewgauge.plans.silver import Star
from crewgauge.sinks.tables import Warehouse
from crewgauge.sources.bronze import Bronze


def load_bronze(warehouse: Warehouse, bronze: Bronze, rejects: DataFrame | None = None) -> Bronze:
    """Bronze tables, and the lines that their sources put aside, if any were looked for."""
    tables = {"employees": bronze.employees, "recruitment": bronze.recruitment, "absence": bronze.absence}
    if bronze.terminations is not None:
        tables["terminations"] = bronze.terminations
    if rejects is not None:
        tables["rejects"] = rejects
    keyed = {"unique_key": "EmployeeNumber"}
    stored = warehouse.replace_all("bronze", tables, employees=keyed, recruitment=keyed, terminations=keyed)
    return Bronze(
        employees=stored["employees"],
        recruitment=stored["recruitment"],
        spells=stored["absence"],
        terminations=stored.get("terminations"),
    )


def build_silver(warehouse: Warehouse, bronze: Bronze, params: Params) -> Star:
    """All silver tables, published together once their keys and references hold (``publish_checked``).

    Dimensions are stored first: the facts then join tables whose size is on record.
    """
    staged = warehouse.stage_all(
        "silver",
        {
            "dim_department": silver.dim_department(bronze.employees),
            "dim_job_role": silver.dim_job_role(bronze.employees),
            "dim_date": silver.dim_date(bronze.hires, params.as_of),
        },
    )
    departments, roles = staged["dim_department"].rows, staged["dim_job_role"].rows
    hired = silver.hired_rows(bronze, params)
    keyed = {"unique_key": "employee_key"}
    staged |= warehouse.stage_all(
        "silver",
        {
            "dim_employee": silver.dim_employee(bronze.employees, departments, roles),
            "fact_employment": silver.fact_employment(hired, departments, roles, params),
            "fact_absence": silver.fact_absence(bronze.absence),
            "fact_recruitment": silver.fact_recruitment(bronze.recruitment),
        },
        dim_employee=keyed,
        fact_employment=keyed,
        fact_recruitment=keyed,
        fact_absence={"order": ("employee_key", "absence_date", "absence_key")},
    )
    return Star(**publish_checked(warehouse, "silver", staged))


def build_gold(warehouse: Warehouse, star: Star, params: Params) -> list[str]:
    analysis = warehouse.replace(
        "gold", "employee_analysis", gold.employee_analysis_from_star(star, params), unique_key="employee_key"
    )
    marts = {
        "kpi_turnover": gold.kpi_turnover(analysis, params),
        "kpi_absenteeism": gold.kpi_absenteeism(analysis),
        "absence_by_reason": gold.absence_by_reason(star.fact_absence),
        "absence_monthly": gold.absence_monthly(star.fact_absence, star.dim_date),
        "kpi_quality_of_hire": gold.kpi_quality_of_hire(analysis),
        "headcount_monthly": gold.headcount_monthly(star.fact_employment, star.dim_date, params),
        "attrition_drivers": gold.attrition_drivers(analysis),
    }
    warehouse.replace_all("gold", marts)
    return ["employee_analysis", *marts]


def build(warehouse: Warehouse, bronze: Bronze, params: Params, rejects: DataFrame | None = None) -> Star:
    """The whole pipeline. Running it again replaces every table."""
    warehouse.create_layers()
    star = build_silver(warehouse, load_bronze(warehouse, bronze, rejects), params)
    build_gold(warehouse, star, params)
    return star
