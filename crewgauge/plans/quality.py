"""Checks of the declared keys and references of the silver tables."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from crewgauge.plans.silver import Star

# Table -> columns declared unique.
UNIQUE = {
    "dim_department": ("department_key", "department_name"),
    "dim_job_role": ("job_role_key", "job_role_name"),
    "dim_date": ("date_key",),
    "dim_employee": ("employee_key",),
    "fact_employment": ("employee_key",),
    "fact_absence": ("absence_key",),
    "fact_recruitment": ("recruitment_key",),
}

# Fixed values: (table, column, referenced table) of the declared references.
REFERENCES = (
    ("dim_employee", "department_key", "dim_department"),
    ("dim_employee", "job_role_key", "dim_job_role"),
    ("fact_employment", "employee_key", "dim_employee"),
    ("fact_employment", "department_key", "dim_department"),
    ("fact_employment", "job_role_key", "dim_job_role"),
    ("fact_absence", "employee_key", "dim_employee"),
    ("fact_recruitment", "employee_key", "dim_employee"),
)


def _stack(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def repeated_keys(star: Star) -> DataFrame:
    """Per declared key: distinct values that occur more than once, and the rows they cover."""
    tables = star.tables()

    def check(table: str, column: str) -> DataFrame:
        uses = tables[table].where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("uses"))
        repeated = F.col("uses") > 1
        return uses.agg(
            F.count_if(repeated).alias("repeated_keys"),
            F.coalesce(F.sum(F.when(repeated, F.col("uses"))), F.lit(0)).alias("repeated_rows"),
        ).select(F.lit(table).alias("table_name"), F.lit(column).alias("column_name"), "repeated_keys", "repeated_rows")

    return _stack([check(t, c) for t, columns in UNIQUE.items() for c in columns])


def orphans(star: Star) -> DataFrame:
    """Per declared reference: values without a partner, and the rows that hold them.

    Rows are counted per value before the anti join, so a value that a third of the rows share
    meets the join as a single row.
    """
    tables = star.tables()

    def check(table: str, column: str, target: str) -> DataFrame:
        uses = tables[table].where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("uses"))
        lost = uses.join(tables[target].select(column), column, "left_anti")
        return lost.agg(
            F.count("*").alias("orphan_keys"), F.coalesce(F.sum("uses"), F.lit(0)).alias("orphan_rows")
        ).select(
            F.lit(table).alias("table_name"),
            F.lit(column).alias("column_name"),
            F.lit(target).alias("references_table"),
            "orphan_keys",
            "orphan_rows",
        )

    return _stack([check(*reference) for reference in REFERENCES])


def violations(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Every value that breaks a declared key or reference of ``tables``, with the number of its rows.

    ``rule`` is ``unique`` (a key that occurs more than once), ``not null`` (the key of a table is missing; ``key`` is null) or
    ``reference`` (a value that the referenced table does not have). Constraints of tables that are not given are left out.
    Rows are counted per value first, so a value that a third of the rows share is one row afterwards.
    """
    found = []

    def report(rows: DataFrame, table: str, column: str, rule: str, target: str | None = None) -> None:
        found.append(
            rows.select(
                F.lit(table).alias("table_name"), F.lit(column).alias("column_name"), F.lit(rule).alias("rule"),
                F.lit(target).cast("string").alias("references_table"), F.col(column).cast("string").alias("key"), "row_count",
            )
        )

    def uses(table: str, column: str) -> DataFrame:
        return tables[table].groupBy(column).agg(F.count("*").alias("row_count"))

    for table, columns in UNIQUE.items():
        if table in tables:
            for column in columns:
                report(uses(table, column).where(F.col(column).isNotNull() & (F.col("row_count") > 1)), table, column, "unique")
            report(uses(table, columns[0]).where(F.col(columns[0]).isNull()), table, columns[0], "not null")
    for table, column, target in REFERENCES:
        if table in tables and target in tables:
            used = uses(table, column).where(F.col(column).isNotNull())
            report(used.join(tables[target].select(column), column, "left_anti"), table, column, "reference", target)
    return _stack(found)


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    return _stack(
        [df.agg(F.count("*").alias("row_count")).select(F.lit(n).alias("table_name"), "row_count") for n, df in tables.items()]
    )
