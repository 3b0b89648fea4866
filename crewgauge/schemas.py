"""Declared schemas. Bronze files are read with these instead of being inferred."""

from __future__ import annotations

from pyspark.sql.types import DateType, DoubleType, IntegerType, LongType, StringType, StructType

_TYPES = {
    "INT": IntegerType(),
    "BIGINT": LongType(),
    "DOUBLE": DoubleType(),
    "STRING": StringType(),
    "DATE": DateType(),
}


def _columns(text: str) -> StructType:
    """A schema from ``name TYPE, ...``; unlike ``StructType.fromDDL`` it needs no session."""
    schema = StructType()
    for column in text.split(","):
        name, kind = column.split()
        schema.add(name, _TYPES[kind])
    return schema


EMPLOYEES = _columns("""
    Age INT, Attrition STRING, BusinessTravel STRING, DailyRate INT, Department STRING,
    DistanceFromHome INT, Education INT, EducationField STRING, EmployeeCount INT,
    EmployeeNumber BIGINT, EnvironmentSatisfaction INT, Gender STRING, HourlyRate INT,
    JobInvolvement INT, JobLevel INT, JobRole STRING, JobSatisfaction INT, MaritalStatus STRING,
    MonthlyIncome INT, MonthlyRate INT, NumCompaniesWorked INT, Over18 STRING, OverTime STRING,
    PercentSalaryHike INT, PerformanceRating INT, RelationshipSatisfaction INT, StandardHours INT,
    StockOptionLevel INT, TotalWorkingYears INT, TrainingTimesLastYear INT, WorkLifeBalance INT,
    YearsAtCompany INT, YearsInCurrentRole INT, YearsSinceLastPromotion INT,
    YearsWithCurrManager INT
""")

ABSENCE = _columns("""
    AbsenceID BIGINT, EmployeeNumber BIGINT, AbsenceDate DATE, AbsenceHours DOUBLE,
    AbsenceDays INT, ReasonCode STRING
""")

RECRUITMENT = _columns("""
    EmployeeNumber BIGINT, SourceChannel STRING, ReqOpenDate DATE, HireDate DATE,
    TimeToFillDays INT, RampUpDays INT, HiringManagerSatisfaction INT, RecruitingCost INT
""")

DIM_DEPARTMENT = _columns("department_key BIGINT, department_name STRING")
DIM_JOB_ROLE = _columns("job_role_key BIGINT, job_role_name STRING")

DIM_DATE = _columns(
    "date_key INT, month_start DATE, year INT, month_num INT, month_name STRING, quarter STRING"
)

DIM_EMPLOYEE = _columns("""
    employee_key BIGINT, department_key BIGINT, job_role_key BIGINT, age INT, age_band STRING,
    gender STRING, marital_status STRING, education INT, education_field STRING, job_level INT,
    business_travel STRING, distance_from_home INT, distance_band STRING, overtime INT,
    num_companies_worked INT, stock_option_level INT, training_times_last_year INT,
    job_satisfaction INT, environment_satisfaction INT, relationship_satisfaction INT,
    work_life_balance INT, job_involvement INT, performance_rating INT, percent_salary_hike INT,
    years_in_current_role INT, years_since_last_promotion INT, years_with_curr_manager INT
""")

FACT_EMPLOYMENT = _columns("""
    employee_key BIGINT, department_key BIGINT, job_role_key BIGINT, hire_date DATE,
    hire_month_key INT, termination_date DATE, term_month_key INT, is_active INT,
    attrition_flag INT, tenure_days INT, tenure_years DOUBLE, tenure_band STRING,
    monthly_income INT, income_band STRING, performance_rating INT
""")

FACT_ABSENCE = _columns("""
    absence_key BIGINT, employee_key BIGINT, absence_date DATE, absence_month_key INT,
    absence_hours DOUBLE, absence_days INT, reason_code STRING
""")

FACT_RECRUITMENT = _columns("""
    recruitment_key BIGINT, employee_key BIGINT, source_channel STRING, req_open_date DATE,
    hire_date DATE, hire_month_key INT, time_to_fill_days INT, ramp_up_days INT,
    hiring_manager_satisfaction INT, recruiting_cost INT
""")

EMPLOYEE_ANALYSIS = _columns("""
    employee_key BIGINT, department_name STRING, job_role_name STRING, age INT, age_band STRING,
    gender STRING, marital_status STRING, education INT, education_field STRING, job_level INT,
    business_travel STRING, distance_from_home INT, distance_band STRING, overtime INT,
    num_companies_worked INT, stock_option_level INT, training_times_last_year INT,
    job_satisfaction INT, environment_satisfaction INT, relationship_satisfaction INT,
    work_life_balance INT, job_involvement INT, performance_rating INT, percent_salary_hike INT,
    years_in_current_role INT, years_since_last_promotion INT, years_with_curr_manager INT,
    hire_date DATE, termination_date DATE, is_active INT, attrition_flag INT, tenure_days INT,
    tenure_years DOUBLE, tenure_band STRING, monthly_income INT, income_band STRING,
    source_channel STRING, time_to_fill_days INT, ramp_up_days INT,
    hiring_manager_satisfaction INT, recruiting_cost INT, exposure_days DOUBLE,
    absence_hours DOUBLE, absence_days BIGINT, absence_spells BIGINT, scheduled_hours DOUBLE,
    absenteeism_rate_pct DOUBLE, bradford_factor DOUBLE, performance_score DOUBLE,
    retention_score DOUBLE, ramp_score DOUBLE, hm_satisfaction_score DOUBLE,
    quality_of_hire DOUBLE
""")
