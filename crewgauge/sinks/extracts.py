"""Flat files for reporting tools: one folder of CSV parts per table."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from crewgauge.plans.gold import ordered_mart
from crewgauge.sinks.tables import Warehouse

# Silver tables shipped as the reporting model.
MODEL_TABLES = (
    "dim_employee", "dim_department", "dim_job_role", "dim_date",
    "fact_employment", "fact_absence", "fact_recruitment",
)


def write_csv(df: DataFrame, path: str) -> None:
    """Header in every part; parts are written where the rows are, never through one task."""
    df.write.mode("overwrite").option("header", True).csv(path)


def export_tables(tables: Mapping[str, DataFrame], folder: str) -> list[str]:
    for name, df in tables.items():
        write_csv(df, f"{folder}/{name}")
    return list(tables)


def export_gold(warehouse: Warehouse, folder: str) -> list[str]:
    """Every table found in the gold layer, those with a report order in it."""
    names = warehouse.table_names("gold")
    return export_tables({n: ordered_mart(n, warehouse.table("gold", n)) for n in names}, folder)


def export_model(warehouse: Warehouse, folder: str) -> list[str]:
    """The star schema under its plain table names."""
    return export_tables({n: warehouse.table("silver", n) for n in MODEL_TABLES}, folder)
