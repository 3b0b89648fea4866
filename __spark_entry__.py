
from __future__ import annotations

import sys
from collections.abc import Callable
from dataclasses import dataclass, replace
from functools import cached_property, reduce
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import DataFrame, SparkSession, functions as F  # noqa: E402

import oracle  # noqa: E402
from crewgauge import schemas  # noqa: E402
from crewgauge.functions.dates import month_key  # noqa: E402
from crewgauge.plans import gold, headlines, measures, quality, silver, study  # noqa: E402
from crewgauge.plans import warehouse as warehouse_plan  # noqa: E402
from crewgauge.session import scratch_database, scratch_path  # noqa: E402
from crewgauge.sinks import document, extracts  # noqa: E402
from crewgauge.plans.publish import ConstraintError  # noqa: E402
from crewgauge.sinks.tables import AUDIT, LAYERS, Warehouse, stored  # noqa: E402
from crewgauge.sources.bronze import Bronze  # noqa: E402
from crewgauge.sources.csv_files import bronze_from_csv, bronze_with_rejects  # noqa: E402
from crewgauge.sources.order_tables import PARAMS, read_bronze  # noqa: E402

try:  # the subpackage may be absent; an error inside it is not hidden
    from crewgauge.llm import queries as text_queries
except ModuleNotFoundError as missing:
    if (missing.name or "").split(".")[:2] not in (["crewgauge", "llm"], ["corpus_pipeline"]):
        raise
    text_queries = None

SMOKE_DIR = "/root/testdata/sf0.001"
RAW_SCHEMAS = {"employees": schemas.EMPLOYEES, "absence": schemas.ABSENCE, "recruitment": schemas.RECRUITMENT}
STUDY_COLUMNS = tuple(dict.fromkeys([
    "is_active", "attrition_flag", "termination_date", "absence_hours", "scheduled_hours", "absence_days", "source_channel", "quality_of_hire",
    "time_to_fill_days", *study.MEASURES, *study.TESTED_DRIVERS,
]))
TRAILING_YEAR = replace(PARAMS, turnover_window_days=365)


@dataclass(frozen=True)
class Frames:
    """The frames of one call, built on first use."""

    spark: SparkSession
    folder: str

    @cached_property
    def bronze(self) -> Bronze:
        return read_bronze(self.spark, self.folder, PARAMS)

    @cached_property
    def built(self) -> Bronze:
        """The same frames for builds of several jobs."""
        return read_bronze(self.spark, self.folder, PARAMS, store_history=True)

    @cached_property
    def departments(self) -> DataFrame:
        return silver.dim_department(self.bronze.employees)

    @cached_property
    def roles(self) -> DataFrame:
        return silver.dim_job_role(self.bronze.employees)

    @cached_property
    def calendar(self) -> DataFrame:
        return silver.dim_date(self.bronze.hires, PARAMS.as_of)

    @cached_property
    def people(self) -> DataFrame:
        return silver.dim_employee(self.bronze.employees, self.departments, self.roles)

    @cached_property
    def employment(self) -> DataFrame:
        hired = silver.hired_rows(self.bronze, PARAMS)
        return silver.fact_employment(hired, self.departments, self.roles, PARAMS)

    @cached_property
    def star(self) -> silver.Star:
        """All silver tables, each computed once: the checks read every one of them several times."""
        star = silver.build_star(self.built, PARAMS)
        return replace(
            star,
            dim_employee=stored(star.dim_employee, "dim_employee"),
            fact_employment=stored(star.fact_employment, "fact_employment"),
        )

    @cached_property
    def spells(self) -> DataFrame:
        return silver.spells(self.bronze.spells)

    @cached_property
    def spans(self) -> DataFrame:
        return gold.employment_spans(self.bronze, PARAMS)

    @cached_property
    def analysis(self) -> DataFrame:
        return gold.employee_analysis(self.bronze, PARAMS)

    @cached_property
    def stored(self) -> Frames:
        """The same frames over a stored analysis table, for queries made of several marts.

        It has the columns that the headline and the study read, not the whole table.
        """
        again = Frames(self.spark, self.folder)
        again.__dict__["analysis"] = stored(self.analysis.select(*STUDY_COLUMNS), "analysis")
        return again

    @cached_property
    def turnover(self) -> DataFrame:
        return gold.kpi_turnover(self.analysis, PARAMS)

    @cached_property
    def absenteeism(self) -> DataFrame:
        return gold.kpi_absenteeism(self.analysis)

    @cached_property
    def quality_of_hire(self) -> DataFrame:
        return gold.kpi_quality_of_hire(self.analysis)

    @cached_property
    def drivers(self) -> DataFrame:
        return gold.attrition_drivers(self.analysis)

    @cached_property
    def reasons(self) -> DataFrame:
        return gold.absence_by_reason(self.spells)

    @cached_property
    def headcount(self) -> DataFrame:
        return gold.headcount_monthly(self.spans, self.calendar, PARAMS)

    @cached_property
    def kpis(self) -> DataFrame:
        """The headline read from stored marts."""
        marts = (self.warehouse.table("gold", f"kpi_{n}") for n in ("turnover", "absenteeism", "quality_of_hire"))
        return headlines.headline(*marts)

    @cached_property
    def headline(self) -> DataFrame:
        return headlines.headline_of(self.analysis, PARAMS)

    @cached_property
    def single(self) -> dict[str, tuple[DataFrame, DataFrame]]:
        """The one-category models over one stored design."""
        columns = stored(self.analysis.select("attrition_flag", "overtime", "business_travel", "tenure_years"), "analysis")
        return {name: study.logistic_model(columns, terms) for name, terms in study.single_terms().items()}

    @cached_property
    def single_odds(self) -> DataFrame:
        odds = [o.withColumn("model", F.lit(name)) for name, (o, _) in self.single.items()]
        return reduce(DataFrame.unionByName, odds)

    @cached_property
    def stepped(self) -> dict[str, DataFrame]:
        """Odds by steps of tenure, against the longest tenures and against the shortest."""
        models = {"risk": ((3.5, 4.0, 4.3, 4.6, 4.9, 5.2, 5.5), "5.5"), "protective": ((5.0, 5.4, 5.5, 5.6, 5.7, 5.8, 5.9, 6.0), "under")}
        rows = self.analysis.select("attrition_flag", *(study.tenure_steps(*edges).alias(name) for name, (edges, _) in models.items()))
        kept = stored(rows, "analysis")
        return {name: study.logistic_model(kept, {"step": study.Category(name, reference)})[0] for name, (_, reference) in models.items()}

    @cached_property
    def separated_terms(self) -> DataFrame:
        """A model with a level that only leavers have and a measure that parts leavers from stayers at one end, beside one proper term."""
        leaver, number = F.col("attrition_flag"), F.col("employee_key")
        rows = self.analysis.select(
            "attrition_flag", "overtime",
            F.when((leaver == 1) & (number % 3 == 0), "left").when(number % 3 == 1, "other").otherwise("base").alias("level"),
            F.when(leaver == 1, number % 2).otherwise(F.lit(0)).alias("end"),
        )
        terms = {"overtime": F.col("overtime"), "level": study.Category("level", "base"), "end": F.col("end")}
        odds, fit = study.logistic_model(rows, terms)
        return odds.where("separated").select("term", "odds_ratio", "separated").join(fit.select("observations", F.col("separated").alias("model_separated")))

    @cached_property
    def regression(self) -> tuple[DataFrame, DataFrame]:
        return study.logistic_model(self.analysis)

    @cached_property
    def document(self) -> DataFrame:
        """The whole study document, written as JSON and read back."""
        f = self.stored
        tests = study.continuous_tests(f.analysis), study.categorical_tests(f.analysis)
        return self.written(study.study_document(self.spark, f.headline, *tests, f.regression))

    def written(self, made: DataFrame) -> DataFrame:
        path = scratch_path(self.spark, "study")
        document.write_document(made, path)
        return document.read_document(self.spark, path, made.schema)

    def exported_raw(self) -> str:
        """The folder of the raw tables as CSV files."""
        folder = scratch_path(self.spark, "raw")
        raw = {
            "employees": self.built.employees.to(schemas.EMPLOYEES),
            "absence": self.built.absence,
            "recruitment": self.built.recruitment,
        }
        extracts.export_tables({n: df.select(*RAW_SCHEMAS[n].names) for n, df in raw.items()}, folder)
        return folder

    @cached_property
    def from_broken_csv(self) -> tuple[Frames, DataFrame]:
        """The frames over raw CSV files with broken lines among the rest, and those lines.

        Broken are a line for every twentieth employee whose age is no number, one for every fiftieth whose date is none, and one that ends early.
        """
        folder = self.exported_raw()
        k = F.col("EmployeeNumber")
        cells = {
            "employees": [F.when(F.lit(c == "Age"), F.lit("unknown")).when(F.lit(c == "EmployeeNumber"), k.cast("string")).otherwise(F.lit("")) for c in RAW_SCHEMAS["employees"].names],
            "absence": [F.lit("0"), k.cast("string"), F.lit("no date"), F.lit("7.5"), F.lit("1"), F.lit("Broken")],
            "recruitment": [k.cast("string"), F.lit("Broken")],
        }
        for name, step in (("employees", 20), ("absence", 50), ("recruitment", 70)):
            lines = self.built.employees.where(k % step == 0).select(F.concat_ws(",", *cells[name]).alias("line"))
            header = self.spark.createDataFrame([(",".join(RAW_SCHEMAS[name].names),)], "line string")
            header.unionByName(lines).coalesce(1).write.mode("append").text(f"{folder}/{name}")
        read, rejects = bronze_with_rejects(
            self.spark, [f"{folder}/preferred", f"{folder}/employees"], f"{folder}/absence", f"{folder}/recruitment"
        )
        again = Frames(self.spark, self.folder)
        again.__dict__["bronze"] = replace(read, terminations=self.built.terminations)
        return again, rejects

    @cached_property
    def from_csv(self) -> Frames:
        """The same frames over raw CSV files; the preferred employee file does not exist."""
        folder = self.exported_raw()
        read = bronze_from_csv(
            self.spark, [f"{folder}/preferred", f"{folder}/employees"], f"{folder}/absence", f"{folder}/recruitment"
        )
        again = Frames(self.spark, self.folder)
        again.__dict__["bronze"] = replace(read, terminations=self.built.terminations)
        return again

    @cached_property
    def warehouse(self) -> Warehouse:
        """A complete stored build in a scratch place of the shared folder."""
        root = scratch_path(self.spark, "warehouse")
        built = self.new_warehouse(root)
        warehouse_plan.build(built, self.built, PARAMS)
        return built

    def new_warehouse(self, root: str, buckets: int | None = None) -> Warehouse:
        made = Warehouse(self.spark, root.rsplit("/", 1)[1].replace("-", "_") + "_", root, buckets)
        for layer in (*LAYERS, AUDIT):
            scratch_database(made.database(layer))
        return made

    @cached_property
    def refused(self) -> DataFrame:
        """What the audit says of a second build with planted faults, and the rows that readers see after it.

        Planted are every hundredth employee a second time, and recruitment rows and absences of numbers that nobody has.
        """
        built = self.new_warehouse(scratch_path(self.spark, "refused"))
        built.create_layers()
        raw = warehouse_plan.load_bronze(built, self.built)
        warehouse_plan.build_silver(built, raw, PARAMS)
        number = F.col("EmployeeNumber")
        faulty = replace(
            raw,
            employees=raw.employees.unionByName(raw.employees.where(number % 100 == 0)),
            recruitment=raw.recruitment.unionByName(raw.recruitment.where(number % 100 == 7).withColumn("EmployeeNumber", -number)),
            spells=raw.spells.withColumn("EmployeeNumber", F.when(number % 100 == 13, -number).otherwise(number)),
        )
        try:
            warehouse_plan.build_silver(built, faulty, PARAMS)
        except ConstraintError as refusal:
            report = refusal.report
        else:
            raise AssertionError("the faulty build was published")
        seen = quality.row_counts({n: built.table("silver", n) for n in built.table_names("silver")})
        return report.unionByName(seen.withColumn("rule", F.lit("seen")), allowMissingColumns=True)

    @cached_property
    def bucketed(self) -> Warehouse:
        """The same build with the employee tables bucketed, so that they join without a shuffle."""
        built = self.new_warehouse(scratch_path(self.spark, "buckets"), buckets=8)
        warehouse_plan.build(built, self.built, PARAMS)
        return built

    def exported(self, export: Callable[[Warehouse, str], list[str]], layer: str, name: str) -> DataFrame:
        """One table of an export of the stored build, read back from its CSV parts."""
        folder = scratch_path(self.spark, "extract")
        export(self.warehouse, folder)
        schema = self.warehouse.table(layer, name).schema
        return self.spark.read.schema(schema).option("header", True).csv(f"{folder}/{name}")


def rounded(df: DataFrame, places: int = 6) -> DataFrame:
    """Doubles cut to a precision that two engines agree on."""
    return df.select(
        *(F.round(c, places).alias(c) if kind == "double" else F.col(c) for c, kind in df.dtypes)
    )


def _flat_kpis(kpis: DataFrame) -> DataFrame:
    for end in ("best_source", "worst_source"):
        kpis = kpis.withColumn(f"{end}_qoh", F.col(f"{end}.qoh")).withColumn(end, F.col(f"{end}.channel"))
    return kpis


def _chi_square(f: Frames) -> DataFrame:
    tests = study.contingency.chi_square(study.contingency_table(f.analysis))
    return rounded(tests.select("driver", "n", "dof", "chi2", "cramers_v"))


def _welch(f: Frames) -> DataFrame:
    tests = study.moments.welch(study.grouped_moments(f.analysis))
    return tests.select(
        "feature", F.round("t", 6).alias("t"), F.round("df", 4).alias("df"), F.round("cohens_d", 6).alias("cohens_d")
    )


def _warehouse_counts(f: Frames) -> DataFrame:
    names = f.warehouse.table_names("gold")
    return quality.row_counts({n: f.warehouse.table("gold", n) for n in names})


_QUERIES: dict[str, Callable[[Frames], DataFrame]] = {
    # Silver
    "dim_department": lambda f: f.departments,
    "dim_job_role": lambda f: f.roles,
    "dim_date": lambda f: f.calendar,
    "dim_employee": lambda f: f.people,
    "fact_employment": lambda f: f.employment,
    "fact_absence": lambda f: silver.fact_absence(f.bronze.absence),
    "fact_recruitment": lambda f: silver.fact_recruitment(f.bronze.recruitment),
    "terminations_hashed": lambda f: silver.derived_terminations(f.bronze.employees, f.bronze.recruitment, PARAMS),
    # Gold
    "absence_per_employee": lambda f: gold.absence_per_employee(f.spells),
    "employee_analysis": lambda f: f.analysis,
    "employee_analysis_star": lambda f: gold.employee_analysis_from_star(f.star, PARAMS),
    "kpi_turnover": lambda f: f.turnover,
    "kpi_turnover_trailing_year": lambda f: gold.kpi_turnover(f.analysis, TRAILING_YEAR),
    "kpi_absenteeism": lambda f: f.absenteeism,
    "kpi_quality_of_hire": lambda f: f.quality_of_hire,
    "attrition_drivers": lambda f: f.drivers,
    "absence_by_reason": lambda f: f.reasons,
    "absence_monthly": lambda f: gold.absence_monthly(f.spells, f.calendar),
    "headcount_monthly": lambda f: f.headcount,
    "headcount_point_in_time": lambda f: gold.monthly_movement(f.spans, f.calendar).select(
        "date_key", "month_start", "active_headcount"
    ),
    "headcount_at_month_by_department": lambda f: f.analysis.select(
        "department_name",
        month_key(F.col("hire_date")).alias("hire_month_key"),
        month_key(F.col("termination_date")).alias("term_month_key"),
    )
    .groupBy("department_name")
    .agg(measures.active_at(200012).alias("active_headcount")),
    "attrition_by_department": lambda f: gold.attrition_by_department(f.employment, f.departments, f.people),
    # Headlines and listings
    "best_worst_source": lambda f: headlines.best_worst_source(stored(f.quality_of_hire, "quality_of_hire")),
    "headline": lambda f: _flat_kpis(f.headline),
    "warehouse_headline": lambda f: _flat_kpis(f.kpis),
    "turnover_by_department": lambda f: headlines.turnover_by_department(f.turnover),
    "quality_by_channel": lambda f: headlines.quality_by_channel(f.quality_of_hire),
    # Reporting measures
    "measures_overall": lambda f: rounded(measures.evaluate(f.analysis)),
    "measures_by_department": lambda f: rounded(measures.evaluate(f.analysis, by=["department_name"])),
    "measures_filtered": lambda f: rounded(
        measures.evaluate(f.analysis, by=["age_band", "gender"], where="overtime = 1")
    ),
    "turnover_status": lambda f: rounded(
        measures.evaluate(f.analysis, ["turnover_rate", "turnover_status"], by=["tenure_band"])
    ),
    "measures_with_subtotals": lambda f: rounded(measures.with_subtotals(f.analysis, by=["department_name", "job_role_name"])),
    "measures_grouping_sets": lambda f: rounded(
        measures.with_subtotals(
            f.analysis, ["headcount", "turnover_rate", "avg_bradford_factor"], ["age_band", "gender", "overtime"], "is_active = 1",
            [["age_band", "gender"], ["overtime"], []],
        )
    ),
    "absence_trend": lambda f: measures.absence_hours_trend(f.spells, f.calendar),
    "absence_trend_filtered": lambda f: measures.absence_hours_trend(
        f.spells, f.calendar, f.analysis, by=["department_name"], where="overtime = 1"
    ),
    "absence_trend_of_some": lambda f: measures.absence_hours_trend(
        f.spells, f.calendar, f.analysis, where="gender = 'Female' AND is_active = 1", spells_where="absence_days >= 3"
    ),
    # Study
    "contingency": lambda f: study.contingency_table(f.analysis),
    "chi_square": _chi_square,
    "categorical_tests": lambda f: study.categorical_tests(f.analysis),
    "grouped_moments": lambda f: rounded(
        study.grouped_moments(f.analysis).select(
            "feature", "n_leavers", "mean_leavers", "sd_leavers", "n_stayers", "mean_stayers", "sd_stayers"
        )
    ),
    "welch_t": _welch,
    "continuous_tests": lambda f: study.continuous_tests(f.analysis),
    "logistic_odds": lambda f: f.regression[0],
    "logistic_fit": lambda f: f.regression[1],
    "logistic_calibration": lambda f: study.logistic_calibration(f.analysis).select(
        "term", F.round("observed", 3).alias("observed"), F.round("fitted", 3).alias("fitted")
    ),
    "single_term_odds": lambda f: f.single_odds.drop("p_value"),
    "single_term_fit": lambda f: reduce(
        DataFrame.unionByName,
        (
            fit.select(F.lit(m).alias("model"), "observations", "pseudo_r2_mcfadden", "llr_p_value", "converged", "separated")
            for m, (_, fit) in f.single.items()
        ),
    ),
    "single_term_p_values": lambda f: f.single_odds.select("model", "term", F.round("p_value", 4).alias("p_value")),
    "single_term_top_risk": lambda f: study.top_risks(f.single_odds).drop("p_value", "model"),
    "single_term_top_protective": lambda f: study.top_protections(f.single_odds).drop("p_value", "model"),
    "single_term_feed": lambda f: headlines.odds_ratio_feed(f.single_odds),
    "stepped_odds": lambda f: reduce(DataFrame.unionByName, (o.withColumn("model", F.lit(m)) for m, o in f.stepped.items())).drop("p_value"),
    "stepped_top_risk": lambda f: study.top_risks(f.stepped["risk"]).drop("p_value"),
    "stepped_top_protective": lambda f: study.top_protections(f.stepped["protective"]).drop("p_value"),
    "separated_terms": lambda f: f.separated_terms,
    "top_risk": lambda f: study.top_risks(f.regression[0]),
    "top_protective": lambda f: study.top_protections(f.regression[0]),
    "study_document": lambda f: f.document,
    "document_kpis": lambda f: _flat_kpis(f.written(study.study_document(f.spark, f.headline)).select("kpis.*")),
    "document_continuous_tests": lambda f: f.written(
        study.study_document(f.spark, continuous=study.continuous_tests(f.analysis))
    ).select(F.inline("continuous_tests")),
    "document_categorical_tests": lambda f: f.written(
        study.study_document(f.spark, categorical=study.categorical_tests(f.analysis))
    ).select(F.inline("categorical_tests")),
    "document_regression": lambda f: f.written(
        study.study_document(f.spark, regression=f.single["long_tenure"])
    ).select("logistic_regression.fit.*", F.inline("logistic_regression.odds_ratios")).drop("p_value", "llr_p_value", "iterations", "separated"),
    # Chart feeds
    "feed_odds_ratios": lambda f: headlines.odds_ratio_feed(f.regression[0]),
    "feed_driver_levels": lambda f: headlines.charted_drivers(f.drivers),
    "feed_one_driver": lambda f: headlines.driver_levels(f.drivers, "Overtime"),
    "feed_department_turnover": lambda f: headlines.turnover_by_department(f.turnover, descending=False),
    "feed_channel_quality": lambda f: headlines.quality_by_channel(f.quality_of_hire, descending=False),
    "feed_headcount": lambda f: headlines.headcount_feed(f.headcount),
    "feed_absence_reason": lambda f: headlines.absence_reason_feed(f.reasons),
    # Checks
    "quality_unique": lambda f: quality.repeated_keys(f.star),
    "quality_orphans": lambda f: quality.orphans(f.star),
    "quality_counts": lambda f: quality.row_counts(f.star.tables()),
    "publish_refused": lambda f: f.refused,
    # Files, stored tables and extracts, written to the shared folder and read back
    "csv_turnover": lambda f: f.from_csv.turnover,
    "csv_absence_by_reason": lambda f: f.from_csv.reasons,
    "csv_tolerant_turnover": lambda f: f.from_broken_csv[0].turnover,
    "csv_rejects": lambda f: f.from_broken_csv[1].select("table_name", "line"),
    "warehouse_turnover": lambda f: f.warehouse.table("gold", "kpi_turnover"),
    "warehouse_counts": _warehouse_counts,
    "warehouse_bucketed_analysis": lambda f: f.bucketed.table("gold", "employee_analysis"),
    "export_gold_csv": lambda f: f.exported(extracts.export_gold, "gold", "kpi_quality_of_hire"),
    "export_star_csv": lambda f: f.exported(extracts.export_model, "silver", "fact_employment"),
}


def entry(spark: SparkSession) -> DataFrame:
    """Turnover by every segment."""
    return _QUERIES["kpi_turnover"](Frames(spark, SMOKE_DIR))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def runner(plan: Callable[[Frames], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, folder: plan(Frames(spark, folder))

    own = {name: runner(plan) for name, plan in _QUERIES.items()}
    return own | (text_queries.queries() if text_queries else {})


def oracle_sql() -> dict[str, str]:
    return oracle.statements() | (text_queries.oracle_sql() if text_queries else {})
