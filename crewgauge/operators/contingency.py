"""Contingency tables, chi-square tests of independence and Cramer's V for many drivers at once."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from crewgauge.functions.numeric import ratio
from crewgauge.functions.tails import chi_square_p_value
from crewgauge.operators.segments import by_segments


def contingency(df: DataFrame, flag: str, drivers: Mapping[str, Column]) -> DataFrame:
    """(driver, level, leavers, stayers) from one pass; rows with a NULL level or flag are left out."""
    observed = {
        "leavers": F.sum(F.when(F.col(flag) == 1, 1).otherwise(0)),
        "stayers": F.sum(F.when(F.col(flag) == 0, 1).otherwise(0)),
    }
    table = by_segments(df.where(F.col(flag).isNotNull()), drivers, observed, type_name="driver", label_name="level")
    return table.where("level IS NOT NULL")


def chi_square(table: DataFrame) -> DataFrame:
    """Per driver: chi2, dof, n, Cramer's V and p, with Yates' correction when dof is 1.

    The margins, one row per driver of a fixed list, are broadcast back to the cells, so the
    cells of a driver of very many levels stay spread over tasks.
    """
    margins = table.groupBy("driver").agg(
        F.sum("leavers").alias("all_leavers"),
        F.sum("stayers").alias("all_stayers"),
        F.count("*").alias("rows"),
    )
    columns = F.when(F.col("all_leavers") > 0, 1).otherwise(0) + F.when(F.col("all_stayers") > 0, 1).otherwise(0)
    n = F.col("all_leavers") + F.col("all_stayers")
    cells = (
        table.join(F.broadcast(margins), "driver")
        .withColumns({"n": n, "dof": (F.col("rows") - 1) * (columns - 1)})
    )

    def term(observed: str, total: str) -> Column:
        row = F.col("leavers") + F.col("stayers")
        expected = ratio(row.cast("double") * F.col(total), F.col("n"))
        gap = F.abs(F.col(observed) - expected)
        corrected = F.when(F.col("dof") == 1, gap - F.least(F.lit(0.5), gap)).otherwise(gap)
        return F.coalesce(ratio(corrected * corrected, expected), F.lit(0.0))

    smallest = F.least(F.col("rows"), F.col("columns"))
    return (
        cells.groupBy("driver")
        .agg(
            F.sum(term("leavers", "all_leavers") + term("stayers", "all_stayers")).alias("chi2"),
            F.max("dof").alias("dof"),
            F.max("n").alias("n"),
            F.max("rows").alias("rows"),
            F.max(columns).alias("columns"),
        )
        .withColumn(
            "cramers_v",
            F.when(smallest > 1, F.sqrt(ratio(F.col("chi2"), F.col("n") * (smallest - 1)))).otherwise(F.lit(0.0)),
        )
        .withColumn("p", chi_square_p_value("chi2", F.col("dof").cast("double")))
        .drop("rows", "columns")
    )
