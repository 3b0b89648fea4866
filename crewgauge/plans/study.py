"""The attrition study: group comparisons, independence tests, regression, result document."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from crewgauge.functions import bands
from crewgauge.operators import contingency, moments
from crewgauge.operators.logistic import Category, calibration, fit_logistic

# Measures compared between leavers and stayers, with their display names.
MEASURES = {
    "monthly_income": "Monthly income",
    "age": "Age",
    "tenure_years": "Tenure (years)",
    "distance_from_home": "Commute distance (km)",
    "years_since_last_promotion": "Years since last promotion",
    "num_companies_worked": "Prior employers",
    "training_times_last_year": "Training sessions last year",
}

# Drivers tested for independence.
TESTED_DRIVERS = {
    "overtime": "Overtime",
    "business_travel": "Business travel",
    "marital_status": "Marital status",
    "job_satisfaction": "Job satisfaction",
    "environment_satisfaction": "Environment satisfaction",
    "work_life_balance": "Work-life balance",
    "job_involvement": "Job involvement",
    "stock_option_level": "Stock option level",
}

# Display names of the regression terms. A term without one shows as it is.
TERM_LABELS = {
    "overtime": "Works overtime",
    "business_travel=Travel_Frequently": "Travels frequently",
    "business_travel=Travel_Rarely": "Travels rarely",
    "marital_status=Single": "Single (vs married)",
    "marital_status=Divorced": "Divorced (vs married)",
    "job_satisfaction": "Job satisfaction (per point)",
    "environment_satisfaction": "Environment satisfaction (per point)",
    "work_life_balance": "Work-life balance (per point)",
    "job_involvement": "Job involvement (per point)",
    "age": "Age (per year)",
    "monthly_income_k": "Monthly income (per $1k)",
    "distance_from_home": "Commute distance (per km)",
    "years_since_last_promotion": "Years since promotion (per year)",
    "num_companies_worked": "Prior employers (per company)",
    "stock_option_level": "Stock option level (per level)",
    "tenure_years": "Tenure (per year)",
}

SIGNIFICANCE = 0.05


def _below_level(p: Column) -> Column:
    """False, not unknown, when the test is undefined."""
    return F.coalesce(p < SIGNIFICANCE, F.lit(False))


def grouped_moments(analysis: DataFrame) -> DataFrame:
    return moments.grouped_moments(analysis, "attrition_flag", MEASURES)


def continuous_tests(analysis: DataFrame) -> DataFrame:
    """Leavers against stayers per measure, largest standardised gap first."""
    tests = moments.welch(grouped_moments(analysis))
    complete = F.col("t").isNotNull() | F.col("cohens_d").isNotNull()
    return tests.select(
        "feature",
        F.when(complete, F.round("mean_leavers", 2)).alias("mean_leavers"),
        F.when(complete, F.round("mean_stayers", 2)).alias("mean_stayers"),
        F.round("cohens_d", 3).alias("cohens_d"),
        bands.effect_level(F.col("cohens_d"), bands.COHEN_D_LEVELS).alias("effect"),
        F.round("p", 5).alias("p_value"),
        _below_level(F.col("p")).alias("significant"),
    ).orderBy(F.abs("cohens_d").desc_nulls_last(), "feature")


def contingency_table(analysis: DataFrame) -> DataFrame:
    return contingency.contingency(
        analysis, "attrition_flag", {label: F.col(c) for c, label in TESTED_DRIVERS.items()}
    )


def categorical_tests(analysis: DataFrame) -> DataFrame:
    """Independence of each driver from leaving, strongest association first."""
    tests = contingency.chi_square(contingency_table(analysis))
    return tests.select(
        "driver",
        F.round("chi2", 2).alias("chi2"),
        F.col("dof").cast("int").alias("dof"),
        F.round("cramers_v", 3).alias("cramers_v"),
        bands.effect_level(F.col("cramers_v"), bands.CRAMER_V_LEVELS).alias("effect"),
        F.round("p", 5).alias("p_value"),
        _below_level(F.col("p")).alias("significant"),
    ).orderBy(F.col("cramers_v").desc(), "driver")


def regression_terms() -> dict[str, Column | Category]:
    """The sixteen terms: overtime, two dummies each for travel and marital status, the rest as is."""
    plain = [
        "job_satisfaction", "environment_satisfaction", "work_life_balance", "job_involvement", "age",
    ]
    later = [
        "distance_from_home", "years_since_last_promotion", "num_companies_worked",
        "stock_option_level", "tenure_years",
    ]
    return {
        "overtime": F.col("overtime"),
        "business_travel": Category("business_travel", "Non-Travel"),
        "marital_status": Category("marital_status", "Married"),
        **{c: F.col(c) for c in plain},
        "monthly_income_k": F.col("monthly_income") / 1000.0,
        **{c: F.col(c) for c in later},
    }


def single_terms() -> dict[str, dict[str, Column | Category]]:
    """One-category models, by name: their odds ratios are those of a contingency table."""
    return {
        "overtime": {"overtime": F.col("overtime")},
        "business_travel": {"business_travel": Category("business_travel", "Non-Travel")},
        "short_tenure": {"short_tenure": F.col("tenure_years") < 5.0},
        "long_tenure": {"long_tenure": F.col("tenure_years") >= 5.5},
    }


def tenure_steps(*edges: float) -> Column:
    """The last of rising ``edges`` that the tenure has reached, as a level; ``under`` before the first."""
    level = F.lit("under")
    for edge in edges:
        level = F.when(F.col("tenure_years") >= edge, F.lit(str(edge))).otherwise(level)
    return level


def logistic_model(
    analysis: DataFrame, terms: Mapping[str, Column | Category] | None = None
) -> tuple[DataFrame, DataFrame]:
    """Odds ratios, highest first, and the fit row. Significance is judged on the rounded p."""
    odds, fit = fit_logistic(analysis, "attrition_flag", terms or regression_terms())
    names = F.create_map(*(F.lit(part) for pair in TERM_LABELS.items() for part in pair))
    p = F.round("p", 5)
    table = odds.select(
        F.coalesce(F.try_element_at(names, "term"), "term").alias("term"),
        F.round("odds_ratio", 3).alias("odds_ratio"),
        F.round("or_low", 3).alias("or_low"),
        F.round("or_high", 3).alias("or_high"),
        p.alias("p_value"),
        _below_level(p).alias("significant"),
        "separated",
    ).orderBy(F.col("odds_ratio").desc_nulls_last(), "term")
    summary = fit.select(
        "observations",
        F.round("pseudo_r2_mcfadden", 3).alias("pseudo_r2_mcfadden"),
        F.round("llr_p_value", 6).alias("llr_p_value"),
        "iterations",
        "converged",
        "separated",
    )
    return table, summary


def logistic_calibration(analysis: DataFrame) -> DataFrame:
    """Observed against fitted sums of every term of the whole model."""
    return calibration(analysis, "attrition_flag", regression_terms())


def top_risks(odds: DataFrame, count: int = 6) -> DataFrame:
    return (
        odds.where("odds_ratio > 1 AND significant").orderBy(F.col("odds_ratio").desc(), "term").limit(count)
    )


def top_protections(odds: DataFrame, count: int = 6) -> DataFrame:
    return odds.where("odds_ratio < 1 AND significant").orderBy("odds_ratio", "term").limit(count)


def _listing(frame: DataFrame, *order: Column) -> Column:
    """All rows of a result frame as one ordered array (these frames have at most 40 rows)."""
    keyed = frame.select(F.struct(*order, F.struct(*frame.columns).alias("_row")).alias("_entry"))
    rows = F.transform(F.array_sort(F.collect_list("_entry")), lambda entry: entry["_row"])
    return keyed.agg(rows).scalar()


def study_document(
    spark: SparkSession,
    kpis: DataFrame | None = None,
    continuous: DataFrame | None = None,
    categorical: DataFrame | None = None,
    regression: tuple[DataFrame, DataFrame] | None = None,
) -> DataFrame:
    """The study as one nested row, ready for the JSON sink; sections that are not given are left out.

    Listings are in the order of their frames; an undefined effect (sort key above zero) comes last.
    """
    sections: dict[str, Column] = {}
    if kpis is not None:
        sections["kpis"] = kpis.select(F.struct(*kpis.columns)).scalar()
    if continuous is not None:
        keys = F.coalesce(-F.abs("cohens_d"), F.lit(0.5)).alias("_k"), F.col("feature").alias("_n")
        sections["continuous_tests"] = _listing(continuous, *keys)
    if categorical is not None:
        keys = (-F.col("cramers_v")).alias("_k"), F.col("driver").alias("_n")
        sections["categorical_tests"] = _listing(categorical, *keys)
    if regression is not None:
        odds, fit = regression
        rows = _listing(odds, F.coalesce(-F.col("odds_ratio"), F.lit(0.5)).alias("_k"), F.col("term").alias("_n"))
        sections["logistic_regression"] = F.struct(
            fit.select(F.struct(*fit.columns)).scalar().alias("fit"), rows.alias("odds_ratios")
        )
    return spark.range(1).select(*(section.alias(name) for name, section in sections.items()))
