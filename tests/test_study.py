"""The study against plain numpy, numeric integration and published identities."""

import math
import random
from datetime import date

import numpy as np
import pytest
from pyspark.sql import functions as F

from crewgauge.functions.tails import chi_square_tail, t_two_sided
from crewgauge.operators.logistic import Category, fit_logistic
from crewgauge.plans import gold, headlines, study
from crewgauge.sinks.document import read_document, write_document
from tests.people import PARAMS, bronze


def simpson(f, low, high, steps=20_000):
    x = np.linspace(low, high, steps + 1)
    weights = np.ones(steps + 1)
    weights[1:-1:2], weights[2:-1:2] = 4, 2
    return float((weights * f(x)).sum() * (high - low) / steps / 3)


@pytest.mark.parametrize("t, df", [(0.0, 5), (0.3, 2.94), (-1.55, 2.94), (2.1, 40.0), (4.0, 800.5), (1.9, 1.0)])
def test_t_tail(t, df):
    constant = 2 * math.exp(math.lgamma((df + 1) / 2) - math.lgamma(df / 2)) / math.sqrt(math.pi)
    low = math.atan(abs(t) / math.sqrt(df))
    expected = constant * simpson(lambda a: np.maximum(np.cos(a), 0) ** (df - 1), low, math.pi / 2)
    assert t_two_sided(t, df) == pytest.approx(expected, abs=1e-9)


@pytest.mark.parametrize("x, dof", [(0.0, 3), (0.446, 1), (3.84, 1), (5.99, 2), (17.5, 3), (90.0, 16), (2.0, 16)])
def test_chi_square_tail(x, dof):
    constant = 2 / 2 ** (dof / 2) / math.gamma(dof / 2)
    low = math.sqrt(x)
    expected = constant * simpson(lambda u: u ** (dof - 1) * np.exp(-u * u / 2), low, low + 40)
    assert chi_square_tail(x, dof) == pytest.approx(expected, abs=1e-9)


def test_published_identities():
    """Result values that follow from one another."""
    assert round(100 * 237 / (1233 + 237 / 2), 1) == 17.5
    assert round(math.sqrt(87.56 / 1470), 3) == 0.244
    assert math.sqrt(3.837 * 7.592) == pytest.approx(5.397, abs=2e-3)
    assert math.sqrt(2.552 * 11.603) == pytest.approx(5.442, abs=2e-3)


def newton(x, y):
    x = np.column_stack([x, np.ones(len(y))])
    beta = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-x @ beta))
        information = x.T @ (x * (p * (1 - p))[:, None])
        beta = beta + np.linalg.solve(information, x.T @ (y - p))
    p = 1 / (1 + np.exp(-x @ beta))
    likelihood = (y * np.log(p) + (1 - y) * np.log(1 - p)).sum()
    base = y.mean()
    null = len(y) * (base * math.log(base) + (1 - base) * math.log(1 - base))
    errors = np.sqrt(np.diag(np.linalg.inv(information)))
    return beta[:-1], errors[:-1], 1 - likelihood / null


def test_regression_matches_newton(spark):
    rng = np.random.default_rng(3)
    n = 1500
    age, travel = rng.integers(20, 60, n), rng.choice(["no", "often", "rare"], n)
    odds = 1.2 - 0.06 * age + 0.9 * (travel == "often")
    y = (rng.random(n) < 1 / (1 + np.exp(-odds))).astype(int)
    rows = [(int(a), str(t), int(v)) for a, t, v in zip(age, travel, y)] + [(None, "no", 1), (30, None, 0)]
    frame = spark.createDataFrame(rows, "age int, travel string, gone int")
    odds_frame, fit_frame = fit_logistic(frame, "gone", {"travel": Category("travel", "no"), "age": F.col("age")})
    beta, errors, r2 = newton(np.column_stack([travel == "often", travel == "rare", age]).astype(float), y)
    got = {r["term"]: r for r in odds_frame.collect()}
    assert set(got) == {"travel=often", "travel=rare", "age"}
    for name, b, e in zip(["travel=often", "travel=rare", "age"], beta, errors):
        assert got[name]["odds_ratio"] == pytest.approx(math.exp(b), rel=1e-6)
        assert got[name]["or_low"] == pytest.approx(math.exp(b - 1.959964 * e), rel=1e-6)
        assert got[name]["or_high"] == pytest.approx(math.exp(b + 1.959964 * e), rel=1e-6)
        assert got[name]["p"] == pytest.approx(math.erfc(abs(b / e) / math.sqrt(2)), abs=1e-8)
    fit = fit_frame.first()
    assert fit["observations"] == n
    assert fit["pseudo_r2_mcfadden"] == pytest.approx(r2, rel=1e-8)


def test_missing_reference_level(spark):
    frame = spark.createDataFrame([("a", 1), ("b", 0)], "x string, y int")
    with pytest.raises(ValueError, match="reference level"):
        fit_logistic(frame, "y", {"x": Category("x", "c")})


@pytest.fixture(scope="module")
def population(spark):
    rng = random.Random(11)
    people = []
    for i in range(700):
        overtime, travel = rng.random() < 0.4, rng.choice(["Non-Travel", "Travel_Rarely", "Travel_Frequently"])
        chance = 0.15 + 0.35 * overtime + 0.2 * (travel == "Travel_Frequently")
        people.append({
            "n": i, "OverTime": "Yes" if overtime else "No", "BusinessTravel": travel,
            "Attrition": "Yes" if rng.random() < chance else "No", "Age": rng.randint(20, 60),
            "MaritalStatus": rng.choice(["Single", "Married", "Divorced"]), "JobSatisfaction": rng.randint(1, 4),
            "EnvironmentSatisfaction": rng.randint(1, 4), "WorkLifeBalance": rng.randint(1, 4),
            "JobInvolvement": rng.randint(1, 4), "MonthlyIncome": rng.randint(2000, 16000),
            "DistanceFromHome": rng.randint(1, 29), "YearsSinceLastPromotion": rng.randint(0, 10),
            "NumCompaniesWorked": rng.randint(0, 9), "StockOptionLevel": rng.randint(0, 3),
            "TrainingTimesLastYear": rng.randint(0, 6), "SourceChannel": rng.choice(["Referral", "Agency"]),
            "HireDate": date(rng.randint(2005, 2024), rng.randint(1, 12), rng.randint(1, 28)),
        })
    raw = bronze(spark, people, [(i, date(2025, 6, 1), 2, "Illness") for i in range(0, 700, 3)])
    return gold.employee_analysis(raw, PARAMS).persist()


def test_sixteen_terms_with_labels(population):
    odds, fit = study.logistic_model(population)
    rows = odds.collect()
    assert {r["term"] for r in rows} == set(study.TERM_LABELS.values())
    assert [r["odds_ratio"] for r in rows] == sorted((r["odds_ratio"] for r in rows), reverse=True)
    assert fit.first()["observations"] == 700
    risks = study.top_risks(odds).collect()
    assert {"Works overtime", "Travels frequently"} <= {r["term"] for r in risks[:3]}
    assert all(r["odds_ratio"] > 1 and r["significant"] for r in risks)
    assert all(r["odds_ratio"] < 1 for r in study.top_protections(odds).collect())
    kinds = {r["term"]: r["kind"] for r in headlines.odds_ratio_feed(odds).collect()}
    assert kinds["Works overtime"] == "risk"


def test_document_round_trip(spark, population, tmp_path):
    odds, fit = study.logistic_model(population)
    kpis = headlines.headline(gold.kpi_turnover(population), gold.kpi_absenteeism(population), gold.kpi_quality_of_hire(population))
    continuous, categorical = study.continuous_tests(population), study.categorical_tests(population)
    made = study.study_document(spark, kpis, continuous, categorical, (odds, fit))
    write_document(made, str(tmp_path / "study"))
    back = read_document(spark, str(tmp_path / "study"), made.schema)
    assert back.collect() == made.collect()
    row = back.first()
    assert [r["feature"] for r in row["continuous_tests"]] == [r["feature"] for r in continuous.collect()]
    assert [r["driver"] for r in row["categorical_tests"]] == [r["driver"] for r in categorical.collect()]
    assert [r["term"] for r in row["logistic_regression"]["odds_ratios"]] == [r["term"] for r in odds.collect()]
    assert row["kpis"]["best_source"]["qoh"] >= row["kpis"]["worst_source"]["qoh"]
    assert row["categorical_tests"][0]["driver"] == "Overtime"


def test_undefined_group_test(population):
    gap = population.withColumn("age", F.when(F.col("employee_key") > 0, F.col("age")))
    row = {r["feature"]: r for r in study.continuous_tests(gap).collect()}["Age"]
    assert (row["p_value"], row["cohens_d"], row["effect"], row["significant"]) == (None, None, None, False)
    assert row["mean_leavers"] is None


def test_undefined_tests_come_last_in_the_document(population):
    gap = population.withColumn("tenure_years", F.when(F.col("employee_key") > 0, F.col("tenure_years")))
    kpis = headlines.headline(gold.kpi_turnover(gap), gold.kpi_absenteeism(gap), gold.kpi_quality_of_hire(gap))
    continuous, categorical = study.continuous_tests(gap), study.categorical_tests(gap)
    odds, fit = study.logistic_model(gap)
    assert fit.first()["observations"] == 699
    listed = study.study_document(kpis.sparkSession, kpis, continuous, categorical, (odds, fit)).first()["continuous_tests"]
    assert [r["feature"] for r in listed] == [r["feature"] for r in continuous.collect()]
    assert listed[-1]["feature"] == "Tenure (years)" and listed[-1]["cohens_d"] is None


def some_outcomes(spark):
    r = random.Random(1)
    rows = []
    for _ in range(500):
        x, level, y, z = r.gauss(0, 1), r.choice("abcd"), int(r.random() < 0.5), r.gauss(0, 1)
        rows.append((1 if level == "c" else y, x, level, z, int(x + z > 0)))
    return spark.createDataFrame(rows, "y int, x double, g string, z double, both int")


def found(odds):
    return {r["term"]: r for r in odds.collect()}


def test_a_separating_level_is_reported(spark):
    """The other terms are those of a fit without the rows that the level predicts."""
    df = some_outcomes(spark)
    odds, fit = fit_logistic(df, "y", {"x": F.col("x"), "g": Category("g", "a")})
    rest, _ = fit_logistic(df.where("g <> 'c'"), "y", {"x": F.col("x"), "g": Category("g", "a")})
    mine, theirs = found(odds), found(rest)
    assert mine["g=c"]["separated"] and mine["g=c"]["odds_ratio"] is None and mine["g=c"]["p"] is None
    for term in ("x", "g=b", "g=d"):
        assert mine[term]["odds_ratio"] == pytest.approx(theirs[term]["odds_ratio"], rel=1e-9) and not mine[term]["separated"]
    row = fit.first()
    assert row["separated"] and row["observations"] == 500 and 0 < row["pseudo_r2_mcfadden"] < 1


def test_a_separating_reference_is_reported(spark):
    df = some_outcomes(spark)
    odds, fit = fit_logistic(df, "y", {"x": F.col("x"), "g": Category("g", "c")})
    rest, _ = fit_logistic(df.where("g <> 'c'"), "y", {"x": F.col("x"), "g": Category("g", "a")})
    mine = found(odds)
    assert all(mine[f"g={v}"]["separated"] and mine[f"g={v}"]["odds_ratio"] is None for v in "abd")
    assert mine["x"]["odds_ratio"] == pytest.approx(found(rest)["x"]["odds_ratio"], rel=1e-9)
    assert fit.first()["separated"]


def test_separating_measures_are_reported(spark):
    df = some_outcomes(spark)
    odds, fit = fit_logistic(df, "y", {"x": F.col("x"), "twin": F.col("y") * 2.0})
    assert found(odds)["twin"]["separated"] and found(odds)["x"]["odds_ratio"] is None
    assert tuple(fit.first())[1:] == (1.0, pytest.approx(0, abs=1e-12), 0, False, True)
    odds, fit = fit_logistic(df, "both", {"x": F.col("x"), "z": F.col("z")})  # neither alone, but both together
    assert all(r["separated"] and r["odds_ratio"] is None for r in found(odds).values())
    assert fit.first()["separated"] and not fit.first()["converged"]


def test_levels_do_not_all_come_to_the_driver(spark):
    many = spark.range(300_000).selectExpr("cast(id % 2 AS int) AS y", "cast(id AS string) AS g")
    with pytest.raises(ValueError, match="more than 4097 levels"):
        fit_logistic(many, "y", {"g": Category("g", "1")})
    some = spark.range(6000).selectExpr("cast(id % 7 < 3 AS int) AS y", "cast(id % 150 AS string) AS g")
    odds, fit = fit_logistic(some, "y", {"g": Category("g", "0")})
    assert odds.count() == 149 and not fit.first()["separated"]
    counts = {r["g"]: (r["a"], r["b"]) for r in some.groupBy("g").agg(F.sum("y").alias("a"), F.sum(1 - F.col("y")).alias("b")).collect()}
    c, d = counts["0"]
    for row in odds.collect():
        a, b = counts[row["term"].removeprefix("g=")]
        assert row["odds_ratio"] == pytest.approx(a * d / (b * c), rel=1e-6)


def test_more_than_six_terms_are_cut(spark):
    import __spark_entry__ as registry

    frames = registry.Frames(spark, "/root/testdata/sf0.01")
    for end, top, better in (("risk", study.top_risks, lambda r: r > 1), ("protective", study.top_protections, lambda r: r < 1)):
        odds = frames.stepped[end].collect()
        assert sum(better(r["odds_ratio"]) and r["significant"] for r in odds) > 6
        assert top(frames.stepped[end]).count() == 6
