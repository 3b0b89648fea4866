"""Headline figures, ordered listings and chart feeds, all read from the marts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from crewgauge.params import Params
from crewgauge.plans import gold


def overall(mart: DataFrame) -> DataFrame:
    return mart.where(F.col("segment_type") == "Overall")


def ranked_sources(quality: DataFrame, best_first: bool = True) -> DataFrame:
    score = F.col("quality_of_hire")
    return quality.where(F.col("segment_type") == "Source channel").orderBy(
        score.desc_nulls_last() if best_first else score.asc_nulls_last(), "segment"
    )


def best_worst_source(quality: DataFrame) -> DataFrame:
    """The channels with the highest and the lowest quality of hire; ties go to the first name."""
    tagged = [
        ranked_sources(quality, best).limit(1).select(
            F.lit(rank).alias("rank"), F.col("segment").alias("channel"), F.col("quality_of_hire").alias("qoh")
        )
        for rank, best in (("best", True), ("worst", False))
    ]
    return tagged[0].unionByName(tagged[1])


def headline(turnover: DataFrame, absenteeism: DataFrame, quality: DataFrame) -> DataFrame:
    """One row of headline figures. Each part is a one-row scalar subquery of its mart."""

    def source(best: bool) -> Column:
        row = ranked_sources(quality, best).limit(1)
        return row.select(F.struct(F.col("segment").alias("channel"), F.col("quality_of_hire").alias("qoh"))).scalar()

    def one(mart: DataFrame, *columns: str) -> Column:
        return overall(mart).select(F.struct(*columns)).scalar()

    parts = turnover.sparkSession.range(1).select(
        one(turnover, "turnover_pct", "separations", "headcount_current").alias("t"),
        one(absenteeism, "absenteeism_rate_pct", "avg_absence_days").alias("a"),
        one(quality, "quality_of_hire", "avg_time_to_fill").alias("q"),
        source(True).alias("best_source"),
        source(False).alias("worst_source"),
    )
    return parts.select(
        F.col("t.turnover_pct").alias("annualised_turnover_pct"),
        "t.separations",
        F.col("t.headcount_current").alias("active_headcount"),
        "a.absenteeism_rate_pct",
        "a.avg_absence_days",
        "q.quality_of_hire",
        F.col("q.avg_time_to_fill").alias("avg_time_to_fill_days"),
        "best_source",
        "worst_source",
    )


def headline_of(analysis: DataFrame, params: Params = Params()) -> DataFrame:
    """The row of ``headline`` straight from the analysis frame, in one pass.

    One aggregate by channel holds the sums behind every figure; the handful of channels is then added up, and the best and
    the worst are the least of a pair of figure and name. As in ``ranked_sources``, undefined scores come last and the first name wins ties.
    """
    totals = {**gold.turnover_totals(params), **gold.absence_totals(), **gold.hire_totals("quality_of_hire", "avg_time_to_fill")}
    channels = analysis.groupBy(F.col("source_channel").alias("channel")).agg(*(t.alias(n) for n, t in totals.items()))
    qoh = gold.hire_average("quality_of_hire").alias("qoh")

    def first(score: Column) -> Column:
        return F.min(F.struct(F.col("qoh").isNull().alias("undefined"), score.alias("score"), F.col("channel"), F.col("qoh")))

    sums = channels.select("*", qoh).agg(
        *(F.sum(n).alias(n) for n in totals), first(-F.col("qoh")).alias("best"), first(F.col("qoh")).alias("worst")
    )
    figures = gold.absence_figures()
    return sums.select(
        gold.turnover_pct().alias("annualised_turnover_pct"),
        "separations",
        F.col("headcount_current").alias("active_headcount"),
        *(figures[n].alias(n) for n in ("absenteeism_rate_pct", "avg_absence_days")),
        gold.hire_average("quality_of_hire").alias("quality_of_hire"),
        gold.hire_average("avg_time_to_fill").alias("avg_time_to_fill_days"),
        *(F.when(F.col(end).isNotNull(), F.struct(f"{end}.channel", f"{end}.qoh")).alias(f"{end}_source") for end in ("best", "worst")),
    )


def turnover_by_department(turnover: DataFrame, descending: bool = True) -> DataFrame:
    rate = F.col("turnover_pct")
    return (
        turnover.where(F.col("segment_type") == "Department")
        .orderBy(rate.desc_nulls_last() if descending else rate.asc_nulls_first(), "segment")
        .select("segment", "turnover_pct")
    )


def quality_by_channel(quality: DataFrame, descending: bool = True) -> DataFrame:
    return ranked_sources(quality, descending).select("segment", "quality_of_hire", "avg_time_to_fill")


# --- chart feeds ------------------------------------------------------------------------------

# The drivers shown side by side.
CHARTED_DRIVERS = ("Job satisfaction", "Work-life balance", "Overtime")


def odds_ratio_feed(odds: DataFrame) -> DataFrame:
    kind = (
        F.when(~F.col("significant"), F.lit("not significant"))
        .when(F.col("odds_ratio") > 1, F.lit("risk"))
        .otherwise(F.lit("protective"))
    )
    return odds.select("term", "odds_ratio", "or_low", "or_high", kind.alias("kind")).orderBy("odds_ratio", "term")


def driver_levels(drivers: DataFrame, driver: str) -> DataFrame:
    """Levels of one driver; the name is a bound parameter."""
    return drivers.sparkSession.sql(
        "SELECT level, attrition_pct FROM {drivers} WHERE driver = :driver ORDER BY level",
        args={"driver": driver},
        drivers=drivers,
    )


def charted_drivers(drivers: DataFrame) -> DataFrame:
    return (
        drivers.where(F.col("driver").isin(*CHARTED_DRIVERS))
        .select("driver", "level", "attrition_pct")
        .orderBy("driver", "level")
    )


def headcount_feed(headcount: DataFrame) -> DataFrame:
    return headcount.select("date_key", "month_start", "active_headcount", "separations").orderBy("date_key")


def absence_reason_feed(reasons: DataFrame) -> DataFrame:
    return reasons.select("reason_code", "absence_hours").orderBy("absence_hours", "reason_code")
