"""Null-propagating, division-safe arithmetic, and sums that do not depend on row order."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def real(value: float) -> Column:
    """A DOUBLE literal, so that products do not become DECIMAL."""
    return F.lit(float(value))


def smaller(a: Column, b: Column) -> Column:
    """Minimum of two values, NULL if either is NULL (``least`` would skip the NULL)."""
    return F.when(a.isNotNull() & b.isNotNull(), F.least(a, b))


def clamp01(value: Column) -> Column:
    return F.when(value.isNotNull(), F.least(real(1), F.greatest(real(0), value)))


def ratio(numerator: Column, denominator: Column) -> Column:
    """Division that yields NULL instead of an error on a zero denominator."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def percent(part: Column, whole: Column, places: int) -> Column:
    return F.round(F.try_divide(real(100) * part, whole.cast("double")), places)


# Decimals that hours are added with.
HOUR_PLACES = 4


def whole_units(value: Column, places: int) -> Column:
    """Sum of values rounded to ``places`` decimals, as a whole number of their last decimal."""
    return F.sum(F.round(value * real(10**places)).cast("bigint"))


def exact_sum(value: Column, places: int = 1) -> Column:
    """Sum of values already rounded to ``places`` decimals, carried as whole numbers.

    Adding doubles gives a result that depends on how rows meet in the shuffle; whole numbers
    always give the same one.
    """
    return whole_units(value, places) / real(10**places)


def exact_avg(value: Column, places: int = 1) -> Column:
    """Average over non-NULL values with the numerator of ``exact_sum``."""
    return F.try_divide(exact_sum(value, places), F.count(value).cast("double"))
