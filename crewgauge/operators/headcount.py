"""Month-by-month headcount from hire and leaving months."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F


def monthly_movement(spans: DataFrame, calendar: DataFrame) -> DataFrame:
    """Active heads, hires and separations for every month of ``calendar``.

    A person counts as active from the hire month up to, but not in, the leaving month. Instead
    of testing every span against every month, each span contributes +1 at its hire month and -1
    at its leaving month; a running sum over the months gives the heads. Spans are reduced to
    one row per month before anything is joined, so the running sum and the join handle at most
    one row per month of the date type, whatever the number of people.

    ``spans`` has hire_month_key and term_month_key. Someone without a hire month is never
    active, and a leaving month before the hire month ends the span in the hire month.
    """
    hired, left = F.col("hire_month_key"), F.col("term_month_key")
    marks = F.array(
        F.struct(hired.alias("month"), F.lit(1).alias("heads"), F.lit(1).alias("hires"), F.lit(0).alias("seps")),
        F.struct(
            F.when(left.isNotNull(), F.greatest(hired, left)).alias("month"),
            F.when(hired.isNotNull(), F.lit(-1)).otherwise(F.lit(0)).alias("heads"),
            F.lit(0).alias("hires"),
            F.lit(0).alias("seps"),
        ),
        F.struct(left.alias("month"), F.lit(0).alias("heads"), F.lit(0).alias("hires"), F.lit(1).alias("seps")),
    )
    # One row per (hire month, leaving month) first: three marks per pair, not per person.
    pairs = spans.groupBy("hire_month_key", "term_month_key").agg(F.count("*").alias("people"))
    per_month = (
        pairs.select("people", F.explode(marks).alias("mark"))
        .where("mark.month IS NOT NULL")
        .groupBy(F.col("mark.month").alias("date_key"))
        .agg(
            F.sum(F.col("people") * F.col("mark.heads")).alias("change"),
            F.sum(F.col("people") * F.col("mark.hires")).alias("hires"),
            F.sum(F.col("people") * F.col("mark.seps")).alias("separations"),
        )
    )
    so_far = Window.orderBy("date_key").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        calendar.join(per_month, "date_key", "left")
        .withColumn("active_headcount", F.sum(F.coalesce("change", F.lit(0))).over(so_far))
        .withColumns({c: F.coalesce(c, F.lit(0)).cast("bigint") for c in ("hires", "separations")})
        .drop("change")
    )
