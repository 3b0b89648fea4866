"""Operators against a second form of the same result, on skewed inputs."""

import random
from datetime import date

import numpy as np
import pytest
from pyspark.sql import Window, functions as F

from crewgauge.operators.contingency import chi_square
from crewgauge.operators.headcount import monthly_movement

from crewgauge.operators.moments import grouped_moments, welch
from crewgauge.operators.numbering import number_rows
from crewgauge.operators.segments import by_segments
from crewgauge.plans.silver import name_dimension


def test_numbers_follow_the_order(spark):
    rows = [(random.Random(i).randint(0, 10**6), i) for i in range(3000)] + [(None, -1)]
    frame = spark.createDataFrame(rows, "k bigint, v bigint")
    numbered = number_rows(frame, ["k", "v"], "n", partitions=7)
    expected = frame.withColumn("n", F.row_number().over(Window.orderBy("k", "v")).cast("bigint")).select("n", "k", "v")
    assert numbered.exceptAll(expected).count() == 0 and numbered.count() == 3001


def test_numbers_with_a_hot_key_and_copies(spark):
    """A third of the rows share a key, and half of those are copies of one row."""
    rows = [(7, i % 500) for i in range(500)] + [(7, -1)] * 500 + [(100 + i, i) for i in range(2000)]
    frame = spark.createDataFrame(rows, "k bigint, v bigint").repartition(5)
    numbered = number_rows(frame, ["k"], "n", partitions=6).collect()
    assert sorted(r["n"] for r in numbered) == list(range(1, 3001))
    assert [r["k"] for r in sorted(numbered, key=lambda r: r["n"])] == sorted(k for k, _ in rows)


def test_slices_split_copies(spark):
    frame = spark.range(4000).select(F.lit(1).alias("k"))
    sliced = frame.withColumn("t", F.rand()).repartitionByRange(4, "k", "t")
    sizes = [r["count"] for r in sliced.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 4 and max(sizes) < 2000


def test_segments_equal_a_union(spark):
    data = [(random.Random(i).choice(["a", "b", None]), i % 3, i % 2) for i in range(500)]
    frame = spark.createDataFrame(data, "dept string, level int, flag int")
    totals = {"n": F.count("*"), "flags": F.sum("flag")}
    segments = {"Dept": F.col("dept"), "Level": F.col("level")}
    result = by_segments(frame, segments, totals, whole=("All", "everyone"))
    union = None
    for name, column in {"All": F.lit("everyone"), **segments}.items():
        part = frame.groupBy(column.cast("string").alias("segment")).agg(*(e.alias(n) for n, e in totals.items()))
        part = part.select(F.lit(name).alias("segment_type"), "segment", "n", "flags")
        union = part if union is None else union.unionByName(part)
    assert result.exceptAll(union).count() == 0 and union.exceptAll(result).count() == 0


def test_segments_of_nothing(spark):
    frame = spark.createDataFrame([], "dept string, flag int")
    totals = {"n": F.count("*"), "flags": F.sum("flag")}
    (row,) = by_segments(frame, {"Dept": F.col("dept")}, totals, whole=("All", "everyone")).collect()
    assert tuple(row) == ("All", "everyone", 0, None)


def test_movement_equals_the_interval_join(spark):
    rng = random.Random(5)
    months = [y * 100 + m for y in (2023, 2024, 2025) for m in range(1, 13)]
    spans = [(rng.choice(months), rng.choice(months + [None] * 20)) for _ in range(800)]
    spans += [(None, 202403), (202405, 202401), (202405, 202405), (202601, None), (202301, 202602)]
    frame = spark.createDataFrame(spans, "hire_month_key int, term_month_key int")
    calendar = spark.createDataFrame([(m,) for m in months], "date_key int")
    got = {r["date_key"]: (r["active_headcount"], r["hires"], r["separations"]) for r in monthly_movement(frame, calendar).collect()}
    for m in months:
        active = sum(1 for h, t in spans if h is not None and h <= m and (t is None or t > m))
        assert got[m] == (active, sum(h == m for h, _ in spans), sum(t == m for _, t in spans))


def test_chi_square_with_and_without_correction(spark):
    cells = [("two", "x", 10, 20), ("two", "y", 30, 40), ("three", "x", 10, 20), ("three", "y", 30, 40), ("three", "z", 5, 5), ("one", "x", 4, 6)]
    table = spark.createDataFrame(cells, "driver string, level string, leavers bigint, stayers bigint")
    rows = {r["driver"]: r for r in chi_square(table).collect()}
    assert rows["two"]["chi2"] == pytest.approx(0.4464, abs=1e-4)
    assert rows["two"]["cramers_v"] == pytest.approx(0.0668, abs=1e-4)
    assert rows["two"]["p"] == pytest.approx(0.50404, abs=1e-4)
    observed = np.array([[10, 20], [30, 40], [5, 5]], float)
    expected = observed.sum(1, keepdims=True) * observed.sum(0) / observed.sum()
    assert rows["three"]["chi2"] == pytest.approx(((observed - expected) ** 2 / expected).sum())
    assert rows["three"]["dof"] == 2
    assert (rows["one"]["dof"], rows["one"]["chi2"], rows["one"]["cramers_v"], rows["one"]["p"]) == (0, 0.0, 0.0, 1.0)


def test_welch(spark):
    data = [(1, 1.0, 5.0, 1.0), (1, 2.0, 5.0, None), (1, 3.0, 5.0, 2.0), (0, 2.0, 5.0, 3.0), (0, 4.0, 5.0, 4.0), (0, 6.0, 5.0, 9.0)]
    frame = spark.createDataFrame(data, "flag int, a double, same double, gap double")
    rows = {r["feature"]: r for r in welch(grouped_moments(frame, "flag", {"a": "A", "same": "Same", "gap": "Gap"})).collect()}
    assert rows["A"]["t"] == pytest.approx(-1.549193, abs=1e-6)
    assert rows["A"]["df"] == pytest.approx(2.941176, abs=1e-6)
    assert rows["A"]["cohens_d"] == pytest.approx(-1.264911, abs=1e-6)
    assert rows["A"]["p"] == pytest.approx(0.2207, abs=2e-3)
    assert rows["Same"]["cohens_d"] == 0.0 and rows["Same"]["t"] is None
    assert rows["Gap"]["missing_leavers"] == 1 and rows["Gap"]["t"] is None and rows["Gap"]["cohens_d"] is None


def test_names_are_numbered_in_order(spark):
    people = spark.createDataFrame([(f" r{i % 30:02}",) for i in range(200)] + [(None,)], "JobRole string")
    names = name_dimension(people, "JobRole", "key", "name")
    assert [r["name"] for r in names.orderBy("key").collect()] == [None, *(f"r{i:02}" for i in range(30))]
    staged = people.select(F.trim("JobRole").alias("name"))
    assert staged.join(names, "name").count() == 200


def test_bradford_of_a_very_busy_employee(spark):
    from crewgauge.functions.scores import bradford_factor

    row = spark.createDataFrame([(3_000_000, 9_000_000)], "s bigint, d bigint").select(bradford_factor(F.col("s"), F.col("d")).alias("b"))
    assert row.first()["b"] == 8.1e19


def test_t_tail_at_many_degrees_of_freedom():
    import math

    from crewgauge.functions.tails import t_two_sided

    for df in (1e6, 1e8, 1e11):
        assert abs(t_two_sided(0.5, df) - math.erfc(0.5 / math.sqrt(2))) < 1e-6


def test_a_category_with_many_levels_is_fitted(spark):
    from crewgauge.operators.logistic import Category, fit_logistic

    rows = [(f"c{i % 150:03}", int((i * 7919 % 10_007) % 3 == 0)) for i in range(15_000)]
    odds, fit = fit_logistic(spark.createDataFrame(rows, "c string, y int"), "y", {"c": Category("c", "c000")})
    assert odds.count() == 149 and fit.first()["converged"]


def test_busy_keys_do_not_change_totals(spark):
    """One employee owns half of all spells."""
    from crewgauge.plans import gold

    rows = [(1, 7.5, 1)] * 3000 + [(i, 15.0, 2) for i in range(2, 3002)]
    spells = spark.createDataFrame(rows, "employee_key bigint, absence_hours double, absence_days int").withColumn(
        "absence_date", F.lit(date(2025, 1, 1))
    )
    got = {r[0]: tuple(r)[1:] for r in gold.absence_per_employee(spells).collect()}
    assert got[1] == (22500.0, 3000, 3000) and got[2] == (15.0, 2, 1) and len(got) == 3001


def test_numbering_nothing(spark):
    assert number_rows(spark.range(0), ["id"], "n").count() == 0


def test_numbers_without_a_given_partition_count(spark):
    frame = spark.range(1000).select((F.col("id") * 37 % 1000).alias("k"))
    numbered = number_rows(frame, ["k"], "n", distinct=True)
    assert numbered.where("n != k + 1").count() == 0 and numbered.count() == 1000


def test_numbering_stores_one_copy(spark, monkeypatch):
    from crewgauge.operators import numbering

    made = []
    monkeypatch.setattr(numbering, "stored", lambda df, name, keep=numbering.stored: made.append(name) or keep(df, name))
    frame = spark.range(900).selectExpr("id % 3 AS k", "if(id < 300, 0, id) AS v")
    numbered = numbering.number_rows(frame, ["k"], "n", partitions=5)
    assert made == ["slices"] and sorted(r["n"] for r in numbered.collect()) == list(range(1, 901))
