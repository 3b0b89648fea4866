"""Banding and code-to-label expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Exclusive upper limits with their labels, then the label of all the rest
# (which also takes NULL). Tenure is in years of 365.25 days.
AGE_BANDS = ((25, "< 25"), (35, "25-34"), (45, "35-44"), (55, "45-54"), (None, "55+"))
TENURE_BANDS = ((1, "< 1 yr"), (3, "1-2 yrs"), (6, "3-5 yrs"), (11, "6-10 yrs"), (None, "10+ yrs"))
INCOME_BANDS = (
    (3000, "< 3k"), (6000, "3-6k"), (10000, "6-10k"), (15000, "10-15k"), (None, "15k+"),
)
# Inclusive upper limits.
DISTANCE_BANDS = ((5, "0-5 km"), (15, "6-15 km"), (None, "16+ km"))

# Thresholds on the absolute effect size.
COHEN_D_LEVELS = ((0.2, "negligible"), (0.5, "small"), (0.8, "medium"), (None, "large"))
CRAMER_V_LEVELS = ((0.1, "negligible"), (0.3, "small"), (0.5, "medium"), (None, "large"))


def band(value: Column, limits, inclusive: bool = False) -> Column:
    """Label of the first limit that ``value`` stays under."""
    (*bounded, (_, rest)) = limits
    chain = F
    for limit, label in bounded:
        chain = chain.when(value <= limit if inclusive else value < limit, F.lit(label))
    return chain.otherwise(F.lit(rest))


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it is false or unknown."""
    return F.when(condition, F.lit(1)).otherwise(F.lit(0))


def overtime_label(overtime: Column) -> Column:
    return F.when(overtime == 1, F.lit("Works overtime")).otherwise(F.lit("No overtime"))


def prefixed(prefix: str, level: Column) -> Column:
    return F.concat(F.lit(prefix), level.cast("string"))


def effect_level(effect: Column, limits) -> Column:
    return F.when(effect.isNotNull(), band(F.abs(effect), limits))


def turnover_status(turnover: Column) -> Column:
    """Traffic light on a turnover fraction; a blank fraction counts as healthy."""
    return (
        F.when(turnover > 0.20, F.lit("High"))
        .when(turnover > 0.12, F.lit("Watch"))
        .otherwise(F.lit("Healthy"))
    )
