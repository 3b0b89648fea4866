"""Logistic regression with Wald intervals on top of Spark's generalized linear model."""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml.feature import OneHotEncoder, StringIndexerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GeneralizedLinearRegression, GeneralizedLinearRegressionModel
from pyspark.sql import Column, DataFrame, functions as F

from crewgauge.functions.tails import chi_square_tail
from crewgauge.sinks.tables import stored

# Fixed value: the 97.5 % point of the normal distribution.
WALD_Z = 1.959964
# The fit ends when no coefficient changes by more than this, or is reported as not converged after so many iterations.
TOLERANCE, ITERATIONS = 1e-12, 200


# Columns of a design that MLlib's solver takes.
MAX_COLUMNS = 4096
# A coefficient whose standard error is this many times as large as itself (or as one) has not come to rest.
RUNAWAY = 100.0


@dataclass(frozen=True)
class Category:
    """A dummy-coded term: its source column and the level that gets no dummy."""

    column: str
    reference: str


@dataclass(frozen=True)
class Design:
    """What goes into a fit: the rows that no column predicts perfectly, and the columns that can be estimated on them."""

    rows: DataFrame
    numeric: tuple[str, ...]
    levels: dict[str, tuple[str, ...]]
    names: tuple[str, ...]
    separated: frozenset[str]
    observations: int
    positives: int
    outcomes: int

    @property
    def columns(self) -> list[str]:
        """The columns of the vector, terms in order; dummies are ``term=level``."""
        return [c for name in self.names for c in ([name] if name in self.numeric else [f"{name}={v}" for v in self.levels.get(name, ())])]


def fit_logistic(
    df: DataFrame, outcome: str, terms: Mapping[str, Column | Category]
) -> tuple[DataFrame, DataFrame]:
    """Fit ``outcome`` (0/1) on ``terms``; return the odds-ratio frame and the one-row fit frame.

    A column that separates the outcomes (a level whose rows all have one outcome, a measure whose ranges do not overlap) has no finite
    estimate: the likelihood grows without end as its coefficient does. It is reported as ``separated`` with no odds
    ratio. The rows that it predicts perfectly add nothing to the likelihood in that limit, so the other terms are fitted on the
    remaining rows; the fit figures are still those of all rows. Coefficients that run away together (separation by several
    columns at once) are told by their standard errors, and reported likewise.
    """
    spark = df.sparkSession
    with _fitted(df, outcome, terms) as (model, _, design):
        found = {}
        n, deviance, iterations, converged = design.observations, 0.0, 0, not design.separated
        if model is not None:
            summary = model.summary
            errors, p_values = summary.coefficientStandardErrors, summary.pValues
            found = {c: (float(b), float(e), float(p)) for c, b, e, p in zip(design.columns, model.coefficients, errors, p_values)}
            deviance, iterations = summary.deviance, summary.numIterations
            converged = iterations < ITERATIONS
    runaway = {c for c, (b, e, _) in found.items() if not e <= RUNAWAY * max(1.0, abs(b))}
    listed = [*(c for c in design.columns if c not in design.separated), *sorted(design.separated)]
    lost = design.separated | runaway
    rows = [(c, *(found[c] if c in found and c not in lost else (None,) * 3), c in lost) for c in listed]
    beta, reach = F.col("beta"), F.lit(WALD_Z) * F.col("error")
    odds = spark.createDataFrame(rows, "term string, beta double, error double, p double, separated boolean").select(
        "term",
        F.exp(beta).alias("odds_ratio"),
        F.exp(beta - reach).alias("or_low"),
        F.exp(beta + reach).alias("or_high"),
        "p",
        "separated",
    )
    null_deviance = _null_deviance(design.observations, design.positives)
    llr_p = chi_square_tail(null_deviance - deviance, float(len(listed))) if null_deviance else None
    pseudo_r2 = 1.0 - deviance / null_deviance if null_deviance else None
    fit = [(n, pseudo_r2, llr_p, int(iterations), converged and not runaway, bool(lost))]
    return odds, spark.createDataFrame(
        fit,
        "observations bigint, pseudo_r2_mcfadden double, llr_p_value double, iterations int, converged boolean, separated boolean",
    )


def calibration(df: DataFrame, outcome: str, terms: Mapping[str, Column | Category]) -> DataFrame:
    """Per term and for the intercept: the sums of outcome times x and of fitted probability times x.

    They are equal exactly where the likelihood has its maximum. Rows that a separating column predicts perfectly are left out.
    """
    with _fitted(df, outcome, terms) as (model, rows, design):
        if model is None:
            raise ValueError("every row is predicted perfectly")
        x = F.concat(F.array(F.lit(1.0)), vector_to_array("_x"))
        values = model.transform(rows).select("_y", "prediction", F.posexplode(x).alias("_at", "_x"))
        sums = values.groupBy("_at").agg(F.sum(F.col("_y") * F.col("_x")).alias("observed"), F.sum(F.col("prediction") * F.col("_x")).alias("fitted"))
        named = F.element_at(F.array(*map(F.lit, ["intercept", *design.columns])), F.col("_at") + 1)
        return stored(sums.select(named.alias("term"), "observed", "fitted"), "calibration")


@contextmanager
def _fitted(
    df: DataFrame, outcome: str, terms: Mapping[str, Column | Category]
) -> Iterator[tuple[GeneralizedLinearRegressionModel | None, DataFrame, Design]]:
    """The model of ``outcome`` (0/1) on ``terms`` (none if nothing is left to fit), its vectors and its design.

    Only the needed columns are written to the shared folder: every iteration of the fit reads
    them, and losing an executor then costs a re-read, not the joins before it. Incomplete rows
    are dropped on the stored columns; dropped earlier, the one predicate over all terms would
    be rewritten for every combination of their aliases while the plan is optimised. Each
    iteration sends a matrix of (terms + 1) squared to the driver, whatever the number of rows.
    """
    inputs = [F.col(outcome).cast("double").alias("_y")]
    for name, term in terms.items():
        source = F.col(term.column).cast("string") if isinstance(term, Category) else term.cast("double")
        inputs.append(source.alias(name))
    rows = stored(df.select(*inputs), "design").dropna().persist(StorageLevel.MEMORY_AND_DISK)
    try:
        design = _design(rows, terms)
        vectors = _vectors(design)
        model = None
        if design.outcomes == 2:
            model = GeneralizedLinearRegression(
                family="binomial", link="logit", labelCol="_y", featuresCol="_x", tol=TOLERANCE, maxIter=ITERATIONS
            ).fit(vectors)
        yield model, vectors, design
    finally:
        rows.unpersist()


def _null_deviance(n: int, positives: int) -> float:
    """Minus twice the log-likelihood of the rate alone."""
    return -2.0 * sum(k * math.log(k / n) for k in (positives, n - positives) if k)


def _level_counts(rows: DataFrame, name: str, room: int) -> dict[str, tuple[int, float]]:
    """Rows and positive outcomes of each level. No more levels than fit into a design ever reach the driver."""
    counts = rows.groupBy(name).agg(F.count("*"), F.sum("_y")).limit(room + 1).collect()
    if len(counts) > room:
        raise ValueError(f"{name} has more than {room} levels, and a design no more than {MAX_COLUMNS} columns")
    return {level: (n, positive) for level, n, positive in sorted(counts)}


def _ranges(rows: DataFrame, names: list[str]) -> dict[str, tuple[float, ...]]:
    """Least and greatest value of each measure among the negative and among the positive rows."""
    ends = [
        f(F.when(F.col("_y") == y, F.col(f"`{name}`")))
        for name in names for y in (0.0, 1.0) for f in (F.min, F.max)
    ]
    row = rows.agg(*(e.alias(f"_{i}") for i, e in enumerate(ends))).first()
    return {name: tuple(row[4 * i : 4 * i + 4]) for i, name in enumerate(names)}


def _design(rows: DataFrame, terms: Mapping[str, Column | Category]) -> Design:
    """The columns of the design and those that separate the outcomes, found by counts of levels and ranges of measures.

    Leaving out what one column predicts can make another one separate the rest, so this is repeated until nothing is found; each turn
    takes out a column.
    """
    observations, positives = rows.agg(F.count("*"), F.coalesce(F.sum("_y"), F.lit(0.0))).first()
    numeric = [n for n, t in terms.items() if not isinstance(t, Category)]
    levels: dict[str, list[str]] = {}
    reference: dict[str, str] = {}
    for name, term in terms.items():
        if isinstance(term, Category):
            room = MAX_COLUMNS + 1 - len(numeric) - sum(map(len, levels.values()))
            found = _level_counts(rows, name, room)
            if term.reference not in found:
                raise ValueError(f"reference level {term.reference!r} of {name} does not occur")
            reference[name] = term.reference
            levels[name] = [v for v in found if v != term.reference]
    if len(numeric) + sum(map(len, levels.values())) > MAX_COLUMNS:
        raise ValueError(f"a design has no more than {MAX_COLUMNS} columns")
    separated: set[str] = set()
    left = rows
    while True:
        out: list[str] = []
        for name, own in levels.items():
            counts = _level_counts(left, name, MAX_COLUMNS + 1)
            for level in list(own):
                n, positive = counts.get(level, (0, 0.0))
                if n == 0 or positive in (0, n):
                    own.remove(level)
                    out += [f"{name}={level}"]
                    left = left.where(F.col(f"`{name}`") != level)
            n, positive = counts.get(reference[name], (0, 0.0))
            if own and (n == 0 or positive in (0, n)):  # all its dummies run away from the reference together
                out += [f"{name}={level}" for level in own]
                left = left.where(F.col(f"`{name}`") != reference[name]) if n else left
                reference[name] = own.pop(0)  # the others still differ from one another
        for name, (low0, high0, low1, high1) in _ranges(left, numeric).items() if numeric else ():
            if None in (low0, low1) or min(low0, low1) == max(high0, high1):
                continue
            if high0 <= low1 or high1 <= low0:
                edge = high0 if high0 <= low1 else high1
                numeric.remove(name)
                out += [name]
                left = left.where(F.col(f"`{name}`") == edge) if edge in (low0, low1) else left.limit(0)
        if not out:
            break
        separated.update(out)
    outcomes = left.select("_y").distinct().count()
    return Design(
        left, tuple(numeric), {n: tuple(v) for n, v in levels.items()}, tuple(terms), frozenset(separated), observations, int(positives), outcomes
    )


def _vectors(design: Design) -> DataFrame:
    """The design as vectors; dummies take up a place only where they are not zero."""
    rows, parts = design.rows, []
    for i, name in enumerate(design.names):
        if name in design.numeric:
            parts.append(name)
        elif design.levels.get(name):
            # Levels in order and whatever else is left (the reference) behind them: the last one gets no dummy.
            index = StringIndexerModel.from_labels(list(design.levels[name]), name, f"_i{i}", handleInvalid="keep")
            rows = index.transform(rows)
            encoder = OneHotEncoder(inputCols=[f"_i{i}"], outputCols=[f"_v{i}"], dropLast=True)
            rows = encoder.fit(rows).transform(rows)
            parts.append(f"_v{i}")
    return VectorAssembler(inputCols=parts, outputCol="_x").transform(rows).select("_y", "_x")
