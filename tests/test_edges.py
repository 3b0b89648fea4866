"""Hand-computed edge rows (as-of 2025-12-31, 5.3392 hours per day)."""

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as registry
from crewgauge.functions import bands, dates, scores
from crewgauge.functions.numeric import percent
from crewgauge.params import Params
from crewgauge.plans import gold, silver
from crewgauge.sources.order_tables import read_bronze
from tests.people import AS_OF, PARAMS, bronze, by_key


def column_values(spark, values, kind, expression):
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r[0] for r in frame.orderBy("i").select(expression(F.col("x"))).collect()]


@pytest.fixture(scope="module")
def analysis(spark):
    people = [
        {"n": 1, "HireDate": date(2025, 12, 31)},
        {"n": 2, "HireDate": date(2025, 12, 26), "Attrition": "Yes"},
        {"n": 3, "HireDate": date(2024, 12, 31)},
        {"n": 4, "HireDate": date(2025, 1, 1)},
        {"n": 5, "HireDate": date(2025, 1, 1), "Attrition": "Yes"},
        {"n": 6, "HireDate": date(2025, 1, 1), "Attrition": "Yes"},
        {"n": 7, "HireDate": date(2020, 1, 1), "Department": " Sales "},
        {"n": 8, "HireDate": date(2020, 1, 1), "Department": None},
        {"n": 9, "hired": False},
        {"n": 10, "HireDate": date(2020, 1, 1), "RampUpDays": None},
        {"n": 11, "HireDate": None},
    ]
    terminations = [
        (2, date(2026, 1, 9)),
        (5, date(2025, 1, 1) + timedelta(days=182)),
        (6, date(2025, 1, 1) + timedelta(days=181)),
    ]
    spells = [(7, date(2025, 3, 1), 1, "Illness"), (7, date(2025, 4, 1), 2, "Illness"), (7, date(2025, 5, 1), 2, "Family")]
    return by_key(gold.employee_analysis(bronze(spark, people, spells, terminations), PARAMS))


def test_hired_on_the_snapshot_day(analysis):
    row = analysis[1]
    assert (row["exposure_days"], row["scheduled_hours"], row["absenteeism_rate_pct"]) == (0.0, 0.0, None)
    assert (row["tenure_days"], row["tenure_band"], row["retention_score"]) == (0, "< 1 yr", None)


def test_termination_after_the_snapshot(analysis):
    row = analysis[2]
    assert row["termination_date"] == date(2026, 1, 9)
    assert (row["tenure_days"], row["retention_score"], row["is_active"]) == (14, 0.0, 0)


def test_a_full_year(analysis):
    row = analysis[3]
    assert (row["exposure_days"], row["scheduled_hours"]) == (365.0, 1948.8)
    assert (row["tenure_days"], row["tenure_years"], row["tenure_band"]) == (365, 1.0, "< 1 yr")
    assert row["retention_score"] == 100.0


def test_too_early_to_judge(analysis):
    row = analysis[4]
    assert (row["tenure_days"], row["retention_score"]) == (364, None)
    assert row["quality_of_hire"] == 55.6


def test_half_horizon(analysis):
    assert analysis[5]["retention_score"] == 50.0
    assert analysis[6]["retention_score"] == 0.0


def test_absence_figures(analysis):
    row = analysis[7]
    assert row["department_name"] == "Sales"
    assert (row["absence_spells"], row["absence_days"], row["absence_hours"]) == (3, 5, 37.5)
    assert (row["bradford_factor"], row["absenteeism_rate_pct"]) == (45, 1.92)


def test_rows_lost_and_kept(analysis):
    assert 8 not in analysis and 9 not in analysis
    assert analysis[10]["ramp_score"] is None and analysis[10]["quality_of_hire"] is None
    unknown = analysis[11]
    assert unknown["exposure_days"] is None and unknown["tenure_band"] == "10+ yrs"


def test_star_gives_the_same_rows(spark):
    people = [{"n": i, "Department": ["Sales", " HR", None][i % 3], "HireDate": date(2020 + i % 6, 1 + i % 12, 5),
               "Attrition": "Yes" if i % 4 == 0 else "No"} for i in range(60)]
    spells = [(i % 40, date(2025, 1 + i % 12, 3), 1 + i % 5, "Illness") for i in range(200)]
    raw = bronze(spark, people, spells)
    direct = gold.employee_analysis(raw, PARAMS)
    star = gold.employee_analysis_from_star(silver.build_star(raw, PARAMS), PARAMS)
    assert direct.schema == star.schema
    assert direct.exceptAll(star).count() == 0 and star.exceptAll(direct).count() == 0
    assert direct.count() == 40


def test_scores(spark):
    assert column_values(spark, [20, 30, 105, 180, 220, None], "int", scores.ramp_score) == [100, 100, 50, 0, 0, None]
    assert column_values(spark, [3, 4], "int", scores.performance_score) == [66.7, 100.0]
    assert column_values(spark, [1, 3, 5], "int", scores.manager_score) == [0, 50, 100]


@pytest.mark.parametrize(
    "performance, ramp, manager, retention, expected",
    [(66.7, 50.0, 50.0, None, 55.6), (66.7, 50.0, 50.0, 100.0, 66.7), (66.7, 49.9, 50.0, 100.0, 66.7), (None, 50.0, 50.0, 100.0, None)],
)
def test_quality_of_hire(spark, performance, ramp, manager, retention, expected):
    frame = spark.createDataFrame([(performance, ramp, manager, retention)], "p double, r double, m double, t double")
    assert frame.select(scores.quality_of_hire(F.col("p"), F.col("r"), F.col("m"), F.col("t"))).first()[0] == expected


def test_bands(spark):
    distance = lambda x: bands.band(x, bands.DISTANCE_BANDS, inclusive=True)
    assert column_values(spark, [5, 6, 15, 16, None], "int", distance) == ["0-5 km", "6-15 km", "6-15 km", "16+ km", "16+ km"]
    assert column_values(spark, [24, 25, 55, None], "int", lambda x: bands.band(x, bands.AGE_BANDS)) == ["< 25", "25-34", "55+", "55+"]
    assert column_values(spark, [2999, 3000, 15000], "int", lambda x: bands.band(x, bands.INCOME_BANDS)) == ["< 3k", "3-6k", "15k+"]
    tenure = lambda x: bands.band(x / F.lit(365.25), bands.TENURE_BANDS)
    assert column_values(spark, [365, 366, 1095, 1096, 4017, 4018], "int", tenure) == [
        "< 1 yr", "1-2 yrs", "1-2 yrs", "3-5 yrs", "6-10 yrs", "10+ yrs",
    ]


def test_missing_names_get_the_first_key(spark):
    raw = bronze(spark, [{"n": 1, "Department": None}, {"n": 2, "Department": " B"}, {"n": 3, "Department": "A"}, {"n": 4, "Department": "B "}])
    rows = {r["department_name"]: r["department_key"] for r in silver.dim_department(raw.employees).collect()}
    assert rows == {None: 1, "A": 2, "B": 3}


def test_hire_and_leave_in_one_month(spark):
    raw = bronze(spark, [{"n": 1, "HireDate": date(2025, 5, 2), "Attrition": "Yes"}, {"n": 2}], terminations=[(1, date(2025, 5, 20))])
    calendar = silver.dim_date(raw.recruitment, AS_OF)
    row = by_key(gold.headcount_monthly(gold.employment_spans(raw, PARAMS), calendar, PARAMS), "date_key")[202505]
    assert (row["hires"], row["separations"], row["active_headcount"]) == (1, 1, 1)


def test_leaver_after_the_snapshot_counts_as_active(spark):
    raw = bronze(spark, [{"n": 1, "HireDate": date(2025, 12, 26), "Attrition": "Yes"}], terminations=[(1, date(2026, 1, 9))])
    calendar = silver.dim_date(raw.recruitment, AS_OF)
    (row,) = gold.headcount_monthly(gold.employment_spans(raw, PARAMS), calendar, PARAMS).collect()
    assert (row["date_key"], row["active_headcount"], row["separations"]) == (202512, 1, 0)


def test_empty_denominator(spark):
    assert spark.range(1).select(percent(F.lit(0), F.lit(0), 1)).first()[0] is None


def test_calendar_starting_after_the_snapshot(spark):
    raw = bronze(spark, [{"n": 1, "HireDate": date(2026, 3, 5)}])
    assert [r["date_key"] for r in silver.dim_date(raw.recruitment, AS_OF).collect()] == [202603]
    assert silver.dim_date(raw.recruitment.limit(0), AS_OF).count() == 0


def test_calendar_labels(spark):
    raw = bronze(spark, [{"n": 1, "HireDate": date(2024, 11, 20)}])
    rows = [tuple(r) for r in silver.dim_date(raw.recruitment, date(2025, 1, 10)).orderBy("date_key").collect()]
    assert rows == [
        (202411, date(2024, 11, 1), 2024, 11, "Nov", "Q4"),
        (202412, date(2024, 12, 1), 2024, 12, "Dec", "Q4"),
        (202501, date(2025, 1, 1), 2025, 1, "Jan", "Q1"),
    ]


def test_first_trailing_month():
    assert dates.first_trailing_month(date(2025, 12, 31), 24) == 202401
    assert dates.first_trailing_month(date(2001, 8, 1), 24) == 199909
    assert dates.first_trailing_month(date(2025, 1, 31), 1) == 202501
    assert dates.first_trailing_month(date(2025, 3, 31), 24) == 202304


def test_derived_departures_stay_in_bounds(spark):
    people = [{"n": i, "Attrition": "Yes" if i % 2 else "No", "HireDate": AS_OF - timedelta(days=3 * i)} for i in range(1, 400)]
    raw = bronze(spark, people)
    frame = silver.derived_terminations(raw.employees, raw.recruitment, PARAMS)
    first, again = by_key(frame, "EmployeeNumber"), by_key(frame, "EmployeeNumber")
    assert first == again and set(first) == {i for i in range(1, 400) if i % 2}
    for i, row in first.items():
        hired = AS_OF - timedelta(days=3 * i)
        assert row["termination_date"] >= hired + timedelta(days=14)
        assert row["termination_date"] >= AS_OF - timedelta(days=364)
        assert row["termination_date"] <= max(AS_OF, hired + timedelta(days=14))
    inline = by_key(gold.employee_analysis(raw, PARAMS))
    assert all(inline[i]["termination_date"] == row["termination_date"] for i, row in first.items())
    assert all(inline[i]["termination_date"] is None for i in range(2, 400, 2))


def test_scheduled_hours_constant():
    assert Params().hours_per_calendar_day == 5.3392


def test_first_orders(spark, tmp_path):
    """The earliest dated order counts, ties go to the smallest key, and marts without its other columns do not sort."""
    at = datetime(2001, 3, 1)
    rows = [(5, 1, at, "late key"), (4, 1, at, "first"), (1, 1, None, "undated"), (9, 1, datetime(2001, 7, 1), "last"), (7, 2, None, "undated")]
    orders = [(key, person, "O", 100.0 * key, day, priority) for key, person, day, priority in rows]
    schema = "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string"
    for name in ("customer", "nation", "region", "lineitem", "part"):
        spark.read.parquet(f"{registry.SMOKE_DIR}/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    spark.createDataFrame(orders, schema).write.parquet(f"{tmp_path}/orders.parquet")
    raw = read_bronze(spark, str(tmp_path))
    hires = raw.recruitment.select("EmployeeNumber", "HireDate", "SourceChannel", "RecruitingCost").orderBy("EmployeeNumber").collect()
    assert [tuple(r) for r in hires] == [(1, date(2001, 3, 1), "first", 4.0), (2, None, None, None)]
    for columns, sorts in ((["HireDate"], False), (["HireDate", "SourceChannel"], True)):
        plan = raw.recruitment.select("EmployeeNumber", *columns)._jdf.queryExecution().executedPlan().toString()
        assert ("SortAggregate" in plan) == sorts
