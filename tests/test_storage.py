"""Files, tables and extracts."""

import csv
from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from crewgauge import schemas
from crewgauge.plans import gold, headlines, measures, quality, silver
from crewgauge.plans import warehouse as plan
from crewgauge.plans.publish import ConstraintError, publish_checked
from crewgauge.session import shared_dir
from crewgauge.sinks import extracts
from crewgauge.sinks.tables import Warehouse
from crewgauge.sources.csv_files import bronze_from_csv, bronze_with_rejects, load_csv, read_csv, read_first_present
from tests.people import PARAMS, bronze


def people(count=40):
    return [
        {"n": i, "Department": ["Sales", "HR"][i % 2], "JobRole": f"Role {i % 3}", "HireDate": date(2021 + i % 5, 1 + i % 12, 9),
         "Attrition": "Yes" if i % 5 == 0 else "No", "OverTime": "Yes" if i % 3 == 0 else "No", "SourceChannel": ["Agency", "Referral"][i % 2]}
        for i in range(count)
    ]


SPELLS = [(i % 20, date(2025, 1 + i % 12, 3), 1 + i % 5, ["Illness", "Family"][i % 2]) for i in range(100)]


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("layers")
    warehouse = Warehouse(spark, prefix="t_", root=str(root), buckets=3)
    raw = bronze(spark, people(), SPELLS)
    star = plan.build(warehouse, raw, PARAMS)
    return warehouse, raw, star


def test_layers_and_tables(built):
    warehouse, _, _ = built
    assert warehouse.table_names("bronze") == ["absence", "employees", "recruitment"]
    assert warehouse.table_names("silver") == sorted(extracts.MODEL_TABLES)
    assert warehouse.table_names("gold") == [
        "absence_by_reason", "absence_monthly", "attrition_drivers", "employee_analysis",
        "headcount_monthly", "kpi_absenteeism", "kpi_quality_of_hire", "kpi_turnover",
    ]


def test_stored_schemas(built):
    warehouse, _, _ = built
    for name, schema in (("dim_employee", schemas.DIM_EMPLOYEE), ("fact_employment", schemas.FACT_EMPLOYMENT),
                         ("fact_absence", schemas.FACT_ABSENCE), ("fact_recruitment", schemas.FACT_RECRUITMENT),
                         ("dim_date", schemas.DIM_DATE), ("dim_department", schemas.DIM_DEPARTMENT)):
        stored = warehouse.table("silver", name).schema
        assert [(f.name, f.dataType) for f in stored] == [(f.name, f.dataType) for f in schema]


def test_stored_analysis_equals_the_direct_one(built):
    warehouse, raw, _ = built
    direct, stored = gold.employee_analysis(raw, PARAMS), warehouse.table("gold", "employee_analysis")
    assert direct.exceptAll(stored).count() == 0 and stored.exceptAll(direct).count() == 0


def test_bucketed_tables_join_without_shuffle(built, spark):
    warehouse, _, star = built
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = star.fact_employment.join(star.dim_employee, "employee_key").join(star.fact_recruitment, "employee_key")
        text = joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in text and "Exchange" not in text


def test_rebuilding_replaces(built):
    warehouse, raw, _ = built
    star = plan.build(warehouse, raw, PARAMS)
    assert star.fact_employment.count() == 40
    counts = {r["table_name"]: r["row_count"] for r in quality.row_counts(star.tables()).collect()}
    assert counts["fact_absence"] == 100 and counts["dim_job_role"] == 3 and counts["fact_recruitment"] == 40


def test_checks_find_problems(spark):
    raw = bronze(spark, people(10) + [{"n": 3}], [(3, date(2025, 1, 1), 1, "Illness"), (99, date(2025, 1, 1), 1, "Illness"), (99, date(2025, 2, 1), 1, "Family")])
    star = silver.build_star(raw, PARAMS)
    repeated = {(r["table_name"], r["column_name"]): (r["repeated_keys"], r["repeated_rows"]) for r in quality.repeated_keys(star).collect()}
    assert repeated["dim_employee", "employee_key"] == (1, 2)
    assert repeated["fact_absence", "absence_key"] == (0, 0)
    lost = {(r["table_name"], r["column_name"]): (r["orphan_keys"], r["orphan_rows"]) for r in quality.orphans(star).collect()}
    assert lost["fact_absence", "employee_key"] == (1, 2)
    assert lost["fact_employment", "department_key"] == (0, 0)


def read_parts(folder):
    rows = []
    for part in sorted(Path(folder).glob("part-*.csv")):
        with part.open(newline="") as handle:
            rows += list(csv.DictReader(handle))
    return rows


def test_exports(built, tmp_path):
    warehouse, _, _ = built
    assert extracts.export_gold(warehouse, str(tmp_path / "gold")) == warehouse.table_names("gold")
    assert extracts.export_model(warehouse, str(tmp_path / "model")) == list(extracts.MODEL_TABLES)
    rows = read_parts(tmp_path / "gold" / "kpi_turnover")
    assert len(rows) == warehouse.table("gold", "kpi_turnover").count()
    assert [r for r in rows if r["segment_type"] == "Overall"][0]["separations"] == "8"
    assert len(read_parts(tmp_path / "model" / "fact_absence")) == 100


def test_csv_sources(built, spark, tmp_path):
    _, raw, _ = built
    folders = {n: str(tmp_path / n) for n in ("employees", "absence", "recruitment")}
    extracts.export_tables({"employees": raw.employees, "absence": raw.spells, "recruitment": raw.recruitment}, str(tmp_path))
    again = bronze_from_csv(spark, [str(tmp_path / "nowhere"), folders["employees"]], folders["absence"], folders["recruitment"])
    for mine, theirs in ((raw.employees, again.employees), (raw.spells, again.spells), (raw.recruitment, again.recruitment)):
        assert mine.schema.names == theirs.schema.names
        assert mine.exceptAll(theirs).count() == 0 and theirs.exceptAll(mine).count() == 0
    with pytest.raises(FileNotFoundError):
        read_first_present(spark, [str(tmp_path / "nowhere")], schemas.EMPLOYEES)


def test_bad_value_is_not_swallowed(spark, tmp_path):
    (tmp_path / "a.csv").write_text("AbsenceID,EmployeeNumber,AbsenceDate,AbsenceHours,AbsenceDays,ReasonCode\n1,2,2025-01-01,7.5,many,Illness\n")
    with pytest.raises(Exception, match="(?i)malformed|FAILFAST|cast"):
        read_csv(spark, str(tmp_path / "a.csv"), schemas.ABSENCE).collect()


def test_bad_lines_are_put_aside(built, spark, tmp_path):
    _, raw, _ = built
    extracts.export_tables({"employees": raw.employees, "absence": raw.spells, "recruitment": raw.recruitment}, str(tmp_path))
    header = ",".join(schemas.ABSENCE.names)
    bad = ["1,2,2025-01-01,7.5,many,Illness", "1,2,yesterday,7.5,1,Illness", "1,2", "1,2,2025-01-01,7.5,1,Illness,more"]
    (tmp_path / "absence" / "part-bad.csv").write_text("\n".join([header, bad[0], "999,7,2025-01-02,,,", *bad[1:]]) + "\n")
    (tmp_path / "recruitment" / "part-bad.csv").write_text(",".join(schemas.RECRUITMENT.names) + "\n")
    again, rejects = bronze_with_rejects(
        spark, [str(tmp_path / "nowhere"), str(tmp_path / "employees")], str(tmp_path / "absence"), str(tmp_path / "recruitment")
    )
    lines = rejects.collect()
    assert sorted((r["table_name"], r["line"]) for r in lines) == sorted(("absence", line) for line in bad)
    assert all(r["file"].endswith("part-bad.csv") for r in lines)
    # Empty cells are no errors.
    assert [tuple(r) for r in again.spells.where("AbsenceID = 999").collect()] == [(999, 7, date(2025, 1, 2), None, None, None)]
    good = again.spells.where("AbsenceID <> 999")
    assert good.exceptAll(raw.spells).count() == raw.spells.exceptAll(good).count() == 0
    # A line is bad whichever columns a query reads.
    assert again.spells.select("EmployeeNumber").count() == raw.spells.count() + 1
    assert again.employees.exceptAll(raw.employees).count() == 0 and again.recruitment.count() == raw.recruitment.count()
    house = Warehouse(spark, prefix="tolerant_", root=str(tmp_path / "house"))
    house.create_layers()
    plan.load_bronze(house, again, rejects)
    assert house.table("bronze", "rejects").count() == 4
    (tmp_path / "few.csv").write_text("AbsenceID,EmployeeNumber\n1,2\n")
    with pytest.raises(ValueError, match="AbsenceDate"):
        load_csv(spark, str(tmp_path / "few.csv"), schemas.ABSENCE)


def test_bound_parameter(built):
    warehouse, _, _ = built
    drivers = warehouse.table("gold", "attrition_drivers")
    assert [r["level"] for r in headlines.driver_levels(drivers, "Overtime").collect()] == ["No overtime", "Works overtime"]
    assert headlines.driver_levels(drivers, "x' OR '1'='1").count() == 0


def test_measures_under_filters(built):
    analysis = built[0].table("gold", "employee_analysis")
    row = measures.evaluate(analysis, ["headcount", "turnover_rate", "turnover_status"], where="department_name = 'HR'").first()
    assert (row["headcount"], row["turnover_status"]) == (20, "High")
    assert row["turnover_rate"] == pytest.approx(4 / (16 + 2))
    nobody = measures.evaluate(analysis, where="department_name = 'None such'").first()
    assert (nobody["headcount"], nobody["turnover_rate"], nobody["cost_per_hire"]) == (0, None, None)
    with pytest.raises(KeyError):
        measures.evaluate(analysis, ["no such measure"])


def test_subtotals_are_the_groupings(built):
    analysis = built[0].table("gold", "employee_analysis")
    rows = measures.with_subtotals(analysis, by=["department_name", "age_band"]).collect()
    for grouping, by in ((0, ["department_name", "age_band"]), (1, ["department_name"]), (2, ["age_band"]), (3, [])):
        mine = [tuple(r[c] for c in (*by, *measures.MEASURES)) for r in rows if r["grouping"] == grouping]
        assert sorted(map(repr, mine)) == sorted(repr(tuple(r)) for r in measures.evaluate(analysis, by=by).collect())
    some = measures.with_subtotals(analysis, ["headcount"], ["gender", "overtime"], sets=[["gender"], []])
    assert "Expand" in (text := some._jdf.queryExecution().executedPlan().toString()) and text.count("FileScan") == 1
    with pytest.raises(KeyError):
        measures.with_subtotals(analysis, ["no such measure"])


def test_trend_in_a_filter_context(built):
    warehouse, _, star = built
    analysis = warehouse.table("gold", "employee_analysis")
    rows = star.fact_absence.join(analysis.select("employee_key", "gender", "department_name", "overtime"), "employee_key").collect()

    def expected(keep, *by):
        sums = {}
        for r in filter(keep, rows):
            key = (r["absence_month_key"], *(r[c] for c in by))
            sums[key] = sums.get(key, 0) + r["absence_hours"]
        return sums

    trend = measures.absence_hours_trend(star.fact_absence, star.dim_date, analysis, ["department_name"], "overtime = 1")
    assert {(r["date_key"], r["department_name"]): r["absence_hours"] for r in trend.collect()} == expected(lambda r: r["overtime"] == 1, "department_name")
    trend = measures.absence_hours_trend(star.fact_absence, star.dim_date, analysis, where="overtime = 1", spells_where="absence_days > 2")
    assert {(r["date_key"],): r["absence_hours"] for r in trend.collect()} == expected(lambda r: r["overtime"] == 1 and r["absence_days"] > 2)
    plan_text = trend._jdf.queryExecution().optimizedPlan().toString()
    assert plan_text.count("LeftSemi") == 1 and plan_text.count("Join") == 2
    nobody = measures.absence_hours_trend(star.fact_absence, star.dim_date, analysis, where="gender = 'None such'")
    assert nobody.count() == 0


def test_shares_need_no_job_beforehand(built, spark):
    """The reason mart is one plan: nothing runs while it is built."""
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("reasons", "")
    gold.absence_by_reason(built[2].fact_absence)
    assert not tracker.getJobIdsForGroup("reasons")
    rows = gold.absence_by_reason(built[2].fact_absence).collect()
    assert sum(r["spells"] for r in rows) == 100 and sum(r["pct_of_hours"] for r in rows) == pytest.approx(100)
    assert gold.absence_by_reason(built[2].fact_absence.limit(0)).collect() == []
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_headline_in_one_pass_is_the_one_of_the_marts(built, spark):
    analysis = built[0].table("gold", "employee_analysis")
    for some in (analysis, analysis.where("source_channel = 'Agency'"), analysis.limit(0), analysis.withColumn("quality_of_hire", F.lit(None).cast("double")),
                 analysis.withColumn("quality_of_hire", F.lit(50.0)), analysis.withColumn("source_channel", F.lit(None).cast("string"))):
        marts = headlines.headline(gold.kpi_turnover(some, PARAMS), gold.kpi_absenteeism(some), gold.kpi_quality_of_hire(some))
        assert headlines.headline_of(some, PARAMS).collect() == marts.collect()
    text = headlines.headline_of(analysis, PARAMS)._jdf.queryExecution().executedPlan().toString()
    assert text.count("FileScan") == 1 and "Subquery" not in text


def test_point_in_time_agrees_with_the_series(built):
    warehouse, _, _ = built
    employment = warehouse.table("silver", "fact_employment")
    series = {r["date_key"]: r["active_headcount"] for r in warehouse.table("gold", "headcount_monthly").collect()}
    for month in (202401, 202506, 202512):
        assert employment.agg(measures.active_at(month)).first()[0] == series[month]


def test_shared_folder_comes_from_the_session(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")


def test_csv_columns_are_found_by_name(spark, tmp_path):
    (tmp_path / "a.csv").write_text(
        "ReasonCode,Note,EmployeeNumber,AbsenceID,AbsenceDate,AbsenceDays,AbsenceHours\nIllness,x,2,1,2025-01-01,1,7.5\n"
    )
    row = read_csv(spark, str(tmp_path / "a.csv"), schemas.ABSENCE).first()
    assert (row["AbsenceID"], row["EmployeeNumber"], row["AbsenceHours"], row["ReasonCode"]) == (1, 2, 7.5, "Illness")
    assert row.__fields__ == schemas.ABSENCE.names
    (tmp_path / "b.csv").write_text("AbsenceID,EmployeeNumber\n1,2\n")
    with pytest.raises(ValueError, match="AbsenceDate"):
        read_csv(spark, str(tmp_path / "b.csv"), schemas.ABSENCE)


def test_release_leaves_nothing_behind(spark):
    import __spark_entry__ as registry
    from crewgauge.session import release, shared_dir

    release(spark)
    queries = registry.queries()
    before = {d.name for d in spark.catalog.listDatabases()}
    assert queries["warehouse_counts"](spark, registry.SMOKE_DIR).count() > 0
    assert queries["headline"](spark, registry.SMOKE_DIR).count() == 1
    assert {d.name for d in spark.catalog.listDatabases()} > before
    release(spark)
    assert {d.name for d in spark.catalog.listDatabases()} == before
    assert not list(Path(shared_dir(spark).removeprefix("file:")).glob("crewgauge/run-*"))


def test_nothing_is_published_before_the_audit(spark, tmp_path):
    house = Warehouse(spark, prefix="audited_", root=str(tmp_path / "house"), buckets=2)
    good = bronze(spark, people(12), SPELLS[:5])
    plan.build(house, good, PARAMS)
    before = {n: house.table("silver", n).collect() for n in house.table_names("silver")}
    versions = {n: house.versions("silver", n) for n in before}
    twice = bronze(spark, people(12) + [{"n": 3}], [*SPELLS[:5], (99, date(2025, 1, 1), 1, "Illness"), (None, date(2025, 1, 1), 1, "Illness")])
    for _ in range(2):
        with pytest.raises(ConstraintError, match="dim_employee.employee_key: unique, 1 values in 2 rows") as refused:
            plan.build(house, twice, PARAMS)
        rows = {(r["table_name"], r["rule"], r["key"]): r["row_count"] for r in refused.value.report.collect()}
        # The employee 3 is there twice, and so are the hires that join with it.
        assert rows["dim_employee", "unique", "3"] == 2 and rows["fact_absence", "reference", "99"] == 1
        assert {n: house.table("silver", n).collect() for n in before} == before
        assert {n: house.versions("silver", n) for n in before} == versions
        assert house.table("audit", "silver").count() == len(rows)
    plan.build(house, good, PARAMS)
    assert house.table("audit", "silver").count() == 0
    assert all(len(house.versions("silver", n)) == 2 for n in before)


def test_audit_reads_published_tables_too(spark, tmp_path):
    house = Warehouse(spark, prefix="partly_", root=str(tmp_path / "house"))
    plan.build(house, bronze(spark, people(6), SPELLS[:3]), PARAMS)
    absences = house.table("silver", "fact_absence")
    missing = absences.withColumn("absence_key", F.lit(None).cast("bigint"))
    with pytest.raises(ConstraintError, match="fact_absence.absence_key: not null, 1 values in 3 rows"):
        publish_checked(house, "silver", {"fact_absence": house.stage("silver", "fact_absence", missing)})
    unknown = absences.withColumn("employee_key", F.lit(77).cast("bigint"))
    with pytest.raises(ConstraintError, match="fact_absence.employee_key: reference, 1 values in 3 rows"):
        publish_checked(house, "silver", {"fact_absence": house.stage("silver", "fact_absence", unknown)})
    publish_checked(house, "silver", {"fact_absence": house.stage("silver", "fact_absence", absences.limit(0))})
    assert house.table("silver", "fact_absence").count() == 0


def test_report_order_of_marts(spark):
    import __spark_entry__ as registry
    from crewgauge.plans.gold import MART_ORDER, ordered_mart

    for name, keys in MART_ORDER.items():
        rows = ordered_mart(name, registry.queries()[name](spark, registry.SMOKE_DIR)).collect()
        key = lambda r: tuple(-(r[k[1:]] or 0) if k[0] == "-" else r[k] or "" for k in keys)  # noqa: E731, B023
        assert rows == sorted(rows, key=key) and len(rows) > 1


def test_listings_keep_their_order(spark):
    import __spark_entry__ as registry

    queries = registry.queries()
    checks = {
        "categorical_tests": lambda r: -r["cramers_v"], "turnover_by_department": lambda r: -r["turnover_pct"],
        "quality_by_channel": lambda r: -r["quality_of_hire"], "feed_department_turnover": lambda r: r["turnover_pct"],
        "feed_headcount": lambda r: r["date_key"], "feed_absence_reason": lambda r: r["absence_hours"],
        "feed_odds_ratios": lambda r: r["odds_ratio"], "feed_driver_levels": lambda r: (r["driver"], r["level"]),
    }
    for name, key in checks.items():
        rows = queries[name](spark, registry.SMOKE_DIR).collect()
        assert [key(r) for r in rows] == sorted(key(r) for r in rows), name


def test_absences_are_stored_in_order(spark):
    """Within a stored part rows follow employee, date and key."""
    import __spark_entry__ as registry
    from pyspark.sql import functions as F

    frames = registry.Frames(spark, registry.SMOKE_DIR)
    stored = frames.warehouse.table("silver", "fact_absence").select(
        F.input_file_name().alias("f"), F.monotonically_increasing_id().alias("n"), "employee_key", "absence_date", "absence_key"
    )
    rows = [(r["f"], r["employee_key"], r["absence_date"], r["absence_key"]) for r in stored.orderBy("f", "n").collect()]
    assert rows == sorted(rows) and rows


def test_replacing_a_table_keeps_its_readers(spark, tmp_path):
    house = Warehouse(spark, prefix="versions_", root=str(tmp_path / "house"))
    house.create_layers()
    first = house.replace("gold", "t", spark.range(3).selectExpr("id AS a"))
    second = house.replace("gold", "t", spark.range(5).selectExpr("id AS b", "id AS c"))
    assert first.count() == 3 and second.count() == house.table("gold", "t").count() == 5
    house.replace("gold", "t", spark.range(7).selectExpr("id AS b"))
    assert house.table_names("gold") == ["t"] and len(house.versions("gold", "t")) == 2
    for layer in ("bronze", "silver", "gold"):
        spark.sql(f"DROP DATABASE {house.database(layer)} CASCADE")
