"""Small bronze frames for tests."""

from __future__ import annotations

from datetime import date, timedelta

from crewgauge import schemas
from crewgauge.params import Params
from crewgauge.sources import Bronze

AS_OF = date(2025, 12, 31)
PARAMS = Params()

DEFAULT_EMPLOYEE = {
    "Age": 30, "Attrition": "No", "BusinessTravel": "Travel_Rarely", "DailyRate": 500, "Department": "Sales",
    "DistanceFromHome": 3, "Education": 3, "EducationField": "Medical", "EmployeeCount": 1,
    "EnvironmentSatisfaction": 3, "Gender": "Female", "HourlyRate": 50, "JobInvolvement": 3, "JobLevel": 2,
    "JobRole": "Manager", "JobSatisfaction": 3, "MaritalStatus": "Single", "MonthlyIncome": 5000,
    "MonthlyRate": 9000, "NumCompaniesWorked": 1, "Over18": "Y", "OverTime": "No", "PercentSalaryHike": 12,
    "PerformanceRating": 3, "RelationshipSatisfaction": 3, "StandardHours": 80, "StockOptionLevel": 1,
    "TotalWorkingYears": 8, "TrainingTimesLastYear": 2, "WorkLifeBalance": 3, "YearsAtCompany": 4,
    "YearsInCurrentRole": 2, "YearsSinceLastPromotion": 1, "YearsWithCurrManager": 2,
}
DEFAULT_HIRE = {
    "SourceChannel": "Referral", "HireDate": date(2020, 1, 15), "TimeToFillDays": 40, "RampUpDays": 105,
    "HiringManagerSatisfaction": 3, "RecruitingCost": 2000,
}


def _frame(spark, rows, schema):
    return spark.createDataFrame([tuple(r.get(c) for c in schema.names) for r in rows], schema)


def bronze(spark, employees, spells=(), terminations=None, hires=True):
    """``employees``: dicts that mix employee and recruitment columns; ``n`` is the number."""
    people, recruits = [], []
    for given in employees:
        number = given["n"]
        people.append({**DEFAULT_EMPLOYEE, **{k: v for k, v in given.items() if k in DEFAULT_EMPLOYEE}, "EmployeeNumber": number})
        if given.get("hired", True):
            hire = {**DEFAULT_HIRE, **{k: v for k, v in given.items() if k in DEFAULT_HIRE}, "EmployeeNumber": number}
            if hire["HireDate"]:
                hire["ReqOpenDate"] = hire["HireDate"] - timedelta(days=hire["TimeToFillDays"])
            recruits.append(hire)
    absence = [
        {"AbsenceID": i, "EmployeeNumber": n, "AbsenceDate": d, "AbsenceHours": 7.5 * days, "AbsenceDays": days, "ReasonCode": reason}
        for i, (n, d, days, reason) in enumerate(spells, 1)
    ]
    return Bronze(
        employees=_frame(spark, people, schemas.EMPLOYEES),
        recruitment=_frame(spark, recruits, schemas.RECRUITMENT),
        spells=_frame(spark, absence, schemas.ABSENCE),
        terminations=None
        if terminations is None
        else spark.createDataFrame(list(terminations), "EmployeeNumber bigint, termination_date date"),
    )


def by_key(df, key="employee_key"):
    return {row[key]: row.asDict() for row in df.collect()}
