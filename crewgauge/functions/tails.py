"""Tail probabilities of Student's t and chi-square.

They are applied to result rows only (one per tested variable). The two incomplete functions
are evaluated with the usual power series and continued fractions (modified Lentz).
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

_TINY = 1e-300
_EPS = 1e-15
# Steps after which a continued fraction counts as undefined; its steps grow with the root of its parameters.
_STEPS = 1_000_000
# Degrees of freedom from which Student's t is the normal distribution to all digits of a double.
_NORMAL = 1e7


def _continued_fraction(terms) -> float:
    """Value of 1 / (1 + a1/(1 + a2/(1 + ...))) style fractions given (a, b) pairs; NaN without convergence."""
    f, c, d = _TINY, _TINY, 0.0
    for a, b in terms:
        d = b + a * d
        d = 1.0 / (d if abs(d) > _TINY else _TINY)
        c = b + a / c
        c = c if abs(c) > _TINY else _TINY
        step = c * d
        f *= step
        if abs(step - 1.0) < _EPS:
            return f
    return math.nan


def _beta_terms(a: float, b: float, x: float):
    yield 1.0, 1.0
    for m in range(0, _STEPS):
        if m:
            yield m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), 1.0
        yield -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)), 1.0


def incomplete_beta(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta function."""
    if x <= 0.0:
        return 0.0
    if x >= 1.0:
        return 1.0
    front = math.exp(
        math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
    )
    if x < (a + 1.0) / (a + b + 2.0):
        return front * _continued_fraction(_beta_terms(a, b, x)) / a
    return 1.0 - front * _continued_fraction(_beta_terms(b, a, 1.0 - x)) / b


def _gamma_terms(a: float, x: float):
    yield 1.0, x + 1.0 - a
    for n in range(1, _STEPS):
        yield -n * (n - a), x + 2 * n + 1.0 - a


def upper_gamma(a: float, x: float) -> float:
    """Regularised upper incomplete gamma function."""
    if x <= 0.0:
        return 1.0
    front = math.exp(a * math.log(x) - x - math.lgamma(a))
    if x >= a + 1.0:
        return front * _continued_fraction(_gamma_terms(a, x))
    term = total = 1.0 / a
    n = a
    while abs(term) > abs(total) * _EPS:
        n += 1.0
        term *= x / n
        total += term
    return 1.0 - front * total


def t_two_sided(t: float, df: float) -> float:
    if df > _NORMAL:
        return math.erfc(abs(t) / math.sqrt(2.0))
    return incomplete_beta(df / 2.0, 0.5, df / (df + t * t))


def chi_square_tail(x: float, dof: float) -> float:
    return upper_gamma(dof / 2.0, x / 2.0)


def _rowwise(function, first: pd.Series, second: pd.Series) -> pd.Series:
    known = first.notna() & second.notna()
    values = [function(a, b) if ok else None for a, b, ok in zip(first, second, known)]
    return pd.Series([None if v is None or math.isnan(v) else v for v in values], dtype="float64")


@F.pandas_udf(DoubleType())
def t_p_value(t: pd.Series, df: pd.Series) -> pd.Series:
    return _rowwise(t_two_sided, t, df)


@F.pandas_udf(DoubleType())
def chi_square_p_value(x: pd.Series, dof: pd.Series) -> pd.Series:
    return _rowwise(chi_square_tail, x, dof)
