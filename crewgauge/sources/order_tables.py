"""The order-processing test tables read as a workforce.

Customers stand in for employees, a customer's first order for the recruitment record, line
items shipped in the absence window for absence spells. The remainders below are fixed values of that mapping.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F

from crewgauge import schemas
from crewgauge.operators.numbering import number_rows
from crewgauge.params import Params
from crewgauge.sinks.tables import stored
from crewgauge.sources.bronze import Bronze

# The latest order date in the tables.
PARAMS = Params(as_of=date(2001, 8, 1))
# Someone without an order for this long has left.
QUIET_DAYS = 180

_EMPLOYEE_COLUMNS = {
    "Age": "18 + k * 7919 % 43",
    "Attrition": "CASE WHEN last_order < quiet_since THEN 'Yes' ELSE 'No' END",
    "BusinessTravel": "CASE WHEN k * 31 % 10 = 0 THEN 'Non-Travel'"
    " WHEN k * 31 % 10 <= 2 THEN 'Travel_Frequently' ELSE 'Travel_Rarely' END",
    "Department": "c_mktsegment",
    "DistanceFromHome": "1 + k * 7853 % 137 % 29",
    "Education": "1 + k % 5",
    "EducationField": "r_name",
    "EmployeeNumber": "k",
    "EnvironmentSatisfaction": "1 + k * 7901 % 103 % 4",
    "Gender": "CASE WHEN k % 5 < 3 THEN 'Male' ELSE 'Female' END",
    "JobInvolvement": "1 + k * 7879 % 109 % 4",
    "JobLevel": "1 + k * 7841 % 139 % 5",
    "JobRole": "n_name",
    "JobSatisfaction": "1 + k * 7907 % 101 % 4",
    "MaritalStatus": "element_at(array('Single', 'Married', 'Divorced'), cast(k % 3 + 1 AS int))",
    "MonthlyIncome": "floor(c_acctbal) + 2000",
    "NumCompaniesWorked": "k * 7867 % 131 % 10",
    "OverTime": "CASE WHEN c_acctbal < 2000 THEN 'Yes' ELSE 'No' END",
    "PercentSalaryHike": "11 + k * 7829 % 149 % 15",
    "PerformanceRating": "CASE WHEN k % 7 = 0 THEN 4 ELSE 3 END",
    "RelationshipSatisfaction": "1 + k * 7793 % 167 % 4",
    "StockOptionLevel": "k * 7877 % 113 % 4",
    "TrainingTimesLastYear": "k * 7789 % 163 % 7",
    "WorkLifeBalance": "1 + k * 7883 % 107 % 4",
    "YearsInCurrentRole": "k * 7823 % 151 % 10",
    "YearsSinceLastPromotion": "k * 7873 % 127 % 16",
    "YearsWithCurrManager": "k * 7817 % 157 % 10",
}
_RECRUITMENT_COLUMNS = {
    "EmployeeNumber": "o_custkey",
    "SourceChannel": "first.o_orderpriority",
    "ReqOpenDate": "date_sub(hire_date, cast(7 + first.o_orderkey * 13 % 174 AS int))",
    "HireDate": "hire_date",
    "TimeToFillDays": "7 + first.o_orderkey * 13 % 174",
    "RampUpDays": "20 + first.o_orderkey * 17 % 201",
    "HiringManagerSatisfaction": "1 + first.o_orderkey * 19 % 5",
    "RecruitingCost": "floor(first.o_totalprice / 100)",
}


def read_bronze(spark: SparkSession, folder: str, params: Params = PARAMS, store_history: bool = False) -> Bronze:
    """The tables as a workforce. ``store_history`` writes the order history of each customer once,
    for builds whose separate jobs would otherwise each aggregate all orders for it."""

    def table(name: str) -> DataFrame:
        return spark.read.parquet(f"{folder}/{name}.parquet")

    orders = table("orders")
    quiet_since = F.lit(params.as_of - timedelta(days=QUIET_DAYS)).cast("date")
    customers = (
        table("customer")
        .join(table("nation"), F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .join(table("region"), F.col("n_regionkey") == F.col("r_regionkey"), "left")
        .withColumns({"k": F.col("c_custkey"), "quiet_since": quiet_since})
    )
    # Reduced per customer before the shuffle, so a customer with very many orders is no hot spot. The first order as a struct
    # takes a sort, so the hire date is a minimum of its own: marts that show nothing else of that order aggregate by hashing.
    # A struct without a date is no first order.
    dated = F.when(F.col("o_orderdate").isNotNull(), F.struct("o_orderdate", "o_orderkey", "o_orderpriority", "o_totalprice"))
    history = orders.groupBy("o_custkey").agg(
        F.min(dated).alias("first"),
        F.to_date(F.min("o_orderdate")).alias("hire_date"),
        F.to_date(F.max("o_orderdate")).alias("last_order"),
    )
    if store_history:
        history = stored(history, "history")
    same = F.col("k") == F.col("o_custkey")
    # Leaving date: the last order, but some days after the first at the soonest.
    departure = F.when(
        F.col("last_order") < quiet_since,
        F.greatest("last_order", F.date_add("hire_date", params.minimum_service_days)),
    ).alias("termination_date")
    return Bronze(
        employees=_columns(customers.join(history, same, "left"), _EMPLOYEE_COLUMNS),
        recruitment=_columns(history, _RECRUITMENT_COLUMNS),
        spells=_spells(table, orders, params),
        terminations=history.select(F.col("o_custkey").alias("EmployeeNumber"), departure).where(
            "termination_date IS NOT NULL"
        ),
        with_absence_id=_number_spells,
        # The earliest of all orders is the earliest first order.
        hire_dates=orders.select(F.to_date("o_orderdate").alias("HireDate")),
    )


def _columns(rows: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Raw columns from SQL expressions, in their declared types."""
    types = {f.name: f.dataType.simpleString() for schema in (schemas.EMPLOYEES, schemas.RECRUITMENT) for f in schema}
    return rows.selectExpr(
        *(f"cast({e} AS {types[c]}) AS {c}" if c in types else f"{e} AS {c}" for c, e in columns.items())
    )


def _spells(table, orders: DataFrame, params: Params) -> DataFrame:
    """The lines of the absence window.

    The window is tested on the stored timestamp, not on a date made from it, so that the test
    reaches the file scan.
    """
    end = params.as_of + timedelta(days=1)
    start = end - timedelta(days=params.absence_window_days)

    def midnight(day: date):
        """From text, so that no time zone comes into it."""
        return F.lit(f"{day.isoformat()} 00:00:00").cast("timestamp_ntz")

    shipped = F.col("l_shipdate")
    lines = table("lineitem").where((shipped >= midnight(start)) & (shipped < midnight(end)))
    days = 1 + F.col("l_quantity").cast("int") % 5
    return (
        lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(table("part"), F.col("l_partkey") == F.col("p_partkey"))
        .select(
            F.col("o_custkey").alias("EmployeeNumber"),
            F.to_date(shipped).alias("AbsenceDate"),
            (F.lit(7.5) * days).alias("AbsenceHours"),
            days.alias("AbsenceDays"),
            F.col("p_type").alias("ReasonCode"),
            *_SPELL_ORDER,
        )
    )


_SPELL_ORDER = [
    "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice",
]


def _number_spells(spells: DataFrame) -> DataFrame:
    """The tables have no single-column line key: number the spells in a fixed order."""
    return number_rows(spells, _SPELL_ORDER, "AbsenceID").drop(*_SPELL_ORDER)
