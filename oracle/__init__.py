"""Independent SQL for every registered query that SQL can express, for a second engine to run.

Each text is one statement: the shared definitions below as common table expressions, then the
query's own SELECT.
"""

from __future__ import annotations

AS_OF = "DATE '2001-08-01'"

# The order tables read as a workforce (fixed values of the mapping), and the silver rows.
_BASE = f"""
WITH ranked_orders AS (
    SELECT o_custkey AS k, o_orderkey, o_orderpriority, o_totalprice,
           CAST(o_orderdate AS DATE) AS day,
           row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS nth,
           max(CAST(o_orderdate AS DATE)) OVER (PARTITION BY o_custkey) AS last_day
    FROM orders
),
hires AS (
    SELECT k, day AS hired, last_day, o_orderpriority AS channel,
           CAST(7 + o_orderkey * 13 % 174 AS INTEGER) AS fill_days,
           CAST(20 + o_orderkey * 17 % 201 AS INTEGER) AS ramp,
           CAST(1 + o_orderkey * 19 % 5 AS INTEGER) AS manager,
           CAST(floor(o_totalprice / 100) AS INTEGER) AS cost
    FROM ranked_orders WHERE nth = 1
),
people AS (
    SELECT c_custkey AS k, trim(c_mktsegment, ' ') AS dept, trim(n_name, ' ') AS job,
           r_name AS field,
           CAST(18 + c_custkey * 7919 % 43 AS INTEGER) AS age,
           CASE WHEN c_custkey % 5 IN (0, 1, 2) THEN 'Male' ELSE 'Female' END AS gender,
           ['Single', 'Married', 'Divorced'][CAST(c_custkey % 3 AS INTEGER) + 1] AS marital,
           CASE c_custkey * 31 % 10 WHEN 0 THEN 'Non-Travel' WHEN 1 THEN 'Travel_Frequently'
                WHEN 2 THEN 'Travel_Frequently' ELSE 'Travel_Rarely' END AS travel,
           CAST(c_acctbal < 2000 AS INTEGER) AS ot,
           CAST(floor(c_acctbal) AS INTEGER) + 2000 AS income,
           CAST(1 + c_custkey * 7853 % 137 % 29 AS INTEGER) AS distance,
           CAST(1 + c_custkey % 5 AS INTEGER) AS education,
           CAST(1 + c_custkey * 7841 % 139 % 5 AS INTEGER) AS job_level,
           CAST(1 + c_custkey * 7907 % 101 % 4 AS INTEGER) AS js,
           CAST(1 + c_custkey * 7901 % 103 % 4 AS INTEGER) AS es,
           CAST(1 + c_custkey * 7883 % 107 % 4 AS INTEGER) AS wlb,
           CAST(1 + c_custkey * 7879 % 109 % 4 AS INTEGER) AS ji,
           CAST(1 + c_custkey * 7793 % 167 % 4 AS INTEGER) AS rs,
           CAST(c_custkey * 7877 % 113 % 4 AS INTEGER) AS stock,
           CAST(c_custkey * 7873 % 127 % 16 AS INTEGER) AS since_promo,
           CAST(c_custkey * 7867 % 131 % 10 AS INTEGER) AS companies,
           CAST(c_custkey * 7789 % 163 % 7 AS INTEGER) AS trainings,
           CAST(c_custkey * 7823 % 151 % 10 AS INTEGER) AS in_role,
           CAST(c_custkey * 7817 % 157 % 10 AS INTEGER) AS with_manager,
           CAST(11 + c_custkey * 7829 % 149 % 15 AS INTEGER) AS hike,
           CAST(3 + (c_custkey % 7 = 0)::INTEGER AS INTEGER) AS rating
    FROM customer
    LEFT JOIN nation ON n_nationkey = c_nationkey
    LEFT JOIN region ON r_regionkey = n_regionkey
),
spells AS (
    SELECT o_custkey AS k, CAST(l_shipdate AS DATE) AS day, p_type AS reason,
           1 + CAST(l_quantity AS INTEGER) % 5 AS days,
           CAST(7.5 * (1 + CAST(l_quantity AS INTEGER) % 5) AS DOUBLE) AS hours,
           l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, l_extendedprice
    FROM lineitem
    JOIN orders ON o_orderkey = l_orderkey
    JOIN part ON p_partkey = l_partkey
    WHERE CAST(l_shipdate AS DATE) > {AS_OF} - 365 AND CAST(l_shipdate AS DATE) <= {AS_OF}
),
departments AS (
    SELECT row_number() OVER (ORDER BY dept NULLS FIRST) AS dept_id, dept
    FROM (SELECT DISTINCT dept FROM people)
),
roles AS (
    SELECT row_number() OVER (ORDER BY job NULLS FIRST) AS job_id, job
    FROM (SELECT DISTINCT job FROM people)
),
calendar AS (
    SELECT CAST(m AS DATE) AS month_start,
           CAST(year(m) * 100 + month(m) AS INTEGER) AS ym,
           CAST(year(m) AS INTEGER) AS yr, CAST(month(m) AS INTEGER) AS mon,
           strftime(m, '%b') AS mon_name, 'Q' || CAST(quarter(m) AS VARCHAR) AS qtr
    FROM (SELECT unnest(generate_series(
        (SELECT CAST(date_trunc('month', min(hired)) AS TIMESTAMP) FROM hires),
        (SELECT CAST(date_trunc('month', greatest(min(hired), {AS_OF})) AS TIMESTAMP) FROM hires),
        INTERVAL 1 MONTH)) AS m)
),
age_limits(lo, hi, label) AS (VALUES (-1000, 25, '< 25'), (25, 35, '25-34'), (35, 45, '35-44'),
    (45, 55, '45-54'), (55, 1000, '55+')),
distance_limits(lo, hi, label) AS (VALUES (-1000, 6, '0-5 km'), (6, 16, '6-15 km'), (16, 100000, '16+ km')),
income_limits(lo, hi, label) AS (VALUES (-1000000, 3000, '< 3k'), (3000, 6000, '3-6k'),
    (6000, 10000, '6-10k'), (10000, 15000, '10-15k'), (15000, 100000000, '15k+')),
tenure_limits(lo, hi, label) AS (VALUES (-1000, 1, '< 1 yr'), (1, 3, '1-2 yrs'), (3, 6, '3-5 yrs'),
    (6, 11, '6-10 yrs'), (11, 10000, '10+ yrs')),
employee_rows AS (
    SELECT p.*, d.dept_id, j.job_id, a.label AS age_band, t.label AS distance_band
    FROM people p
    JOIN departments d ON d.dept = p.dept
    JOIN roles j ON j.job = p.job
    JOIN age_limits a ON p.age >= a.lo AND p.age < a.hi
    JOIN distance_limits t ON p.distance >= t.lo AND p.distance < t.hi
),
service AS (
    SELECT e.*, h.hired, h.channel, h.fill_days, h.ramp, h.manager, h.cost,
           (h.last_day < {AS_OF} - 180) AS gone,
           CASE WHEN h.last_day < {AS_OF} - 180 THEN greatest(h.last_day, h.hired + 14) END AS left_on
    FROM employee_rows e JOIN hires h ON h.k = e.k
),
employment AS (
    SELECT s.*, CAST(date_diff('day', s.hired, coalesce(s.left_on, {AS_OF})) AS INTEGER) AS served,
           t.label AS tenure_band, i.label AS income_band,
           CAST(s.gone AS INTEGER) AS leaver, 1 - CAST(s.gone AS INTEGER) AS stayer,
           CAST(year(s.hired) * 100 + month(s.hired) AS INTEGER) AS hire_ym,
           CAST(year(s.left_on) * 100 + month(s.left_on) AS INTEGER) AS left_ym
    FROM service s
    JOIN tenure_limits t
      ON date_diff('day', s.hired, coalesce(s.left_on, {AS_OF})) / 365.25 >= t.lo
     AND date_diff('day', s.hired, coalesce(s.left_on, {AS_OF})) / 365.25 < t.hi
    JOIN income_limits i ON s.income >= i.lo AND s.income < i.hi
),
absent AS (
    SELECT k, sum(hours) AS hours, CAST(sum(days) AS BIGINT) AS days, count(*) AS spells
    FROM spells GROUP BY k
),
parts AS (
    SELECT e.*,
           coalesce(a.hours, 0) AS abs_hours, coalesce(a.days, 0) AS abs_days,
           coalesce(a.spells, 0) AS abs_spells,
           CAST(least(365, date_diff('day', e.hired, {AS_OF})) AS DOUBLE) AS exposure,
           round((e.rating - 1) * 100.0::DOUBLE / 3, 1) AS s_perf,
           round((e.manager - 1) * 100.0::DOUBLE / 4, 1) AS s_manager,
           round(100.0::DOUBLE * least(1, greatest(0, (180 - e.ramp) / 150.0::DOUBLE)), 1) AS s_ramp,
           CAST(CASE WHEN e.served >= 365 THEN 100 WHEN NOT e.gone THEN NULL
                     WHEN e.served >= 182 THEN 50 ELSE 0 END AS DOUBLE) AS s_stay
    FROM employment e LEFT JOIN absent a ON a.k = e.k
),
analysis AS (
    SELECT *,
           round(exposure * 5.3392::DOUBLE, 1) AS sched,
           round(100 * abs_hours / nullif(exposure * 5.3392::DOUBLE, 0), 2) AS abs_rate,
           abs_spells::DOUBLE * abs_spells * abs_days AS bradford,
           CASE WHEN s_stay IS NULL THEN round((s_perf + s_ramp + s_manager) / 3, 1)
                ELSE round((s_perf + s_ramp + s_manager + s_stay) / 4, 1) END AS qoh
    FROM parts
)
"""

_OVERTIME = "CASE ot WHEN 1 THEN 'Works overtime' ELSE 'No overtime' END"


def _long(source: str, segments: dict[str, str], totals: str, kind: str, label: str) -> str:
    """One aggregate query per segment, glued together."""
    return " UNION ALL ".join(
        f"SELECT '{name}' AS {kind}, {level} AS {label}, {totals} FROM {source} GROUP BY {level}"
        for name, level in segments.items()
    )


def _turnover() -> str:
    segments = {
        "Overall": "'All employees'", "Department": "dept", "Job role": "job",
        "Tenure band": "tenure_band", "Age band": "age_band", "Overtime": _OVERTIME,
    }
    union = _long(
        "analysis", segments,
        "CAST(sum(stayer) AS BIGINT) AS headcount_current, CAST(sum(leaver) AS BIGINT) AS separations",
        "segment_type", "segment",
    )
    return f"""SELECT segment_type, segment, headcount_current, separations,
        round(headcount_current + separations * 0.5::DOUBLE, 1) AS avg_headcount,
        round(100.0::DOUBLE * separations / nullif(headcount_current + separations * 0.5::DOUBLE, 0), 1) AS turnover_pct
        FROM ({union})"""


def _absenteeism() -> str:
    segments = {
        "Overall": "'All employees'", "Department": "dept", "Overtime": _OVERTIME,
        "Work-life balance": "'WLB rating ' || CAST(wlb AS VARCHAR)",
    }
    union = _long(
        "analysis", segments,
        "count(*) AS employees, sum(abs_hours) AS h, "
        "CAST(sum(CAST(sched AS DECIMAL(18, 1))) AS DOUBLE) AS s, CAST(sum(abs_days) AS DOUBLE) AS d",
        "segment_type", "segment",
    )
    return f"""SELECT segment_type, segment, employees, round(h, 0) AS absence_hours,
        round(s, 0) AS scheduled_hours, round(100.0::DOUBLE * h / nullif(s, 0), 2) AS absenteeism_rate_pct,
        round(d / employees, 2) AS avg_absence_days FROM ({union})"""


def _quality() -> str:
    def mean(column: str, places: int) -> str:
        return f"round(CAST(sum(CAST({column} AS DECIMAL(18, 1))) AS DOUBLE) / nullif(count({column}), 0), {places})"

    totals = (
        f"count(*) AS hires, {mean('qoh', 1)} AS quality_of_hire, {mean('s_perf', 1)} AS performance_score, "
        f"{mean('s_stay', 1)} AS retention_score, {mean('s_ramp', 1)} AS ramp_score, "
        f"{mean('s_manager', 1)} AS hm_satisfaction_score, {mean('fill_days', 0)} AS avg_time_to_fill, "
        f"{mean('cost', 0)} AS avg_recruiting_cost"
    )
    return _long(
        "analysis", {"Overall": "'All hires'", "Source channel": "channel"}, totals, "segment_type", "segment"
    )


def _drivers() -> str:
    segments = {
        "Job satisfaction": "'Level ' || CAST(js AS VARCHAR)",
        "Environment satisfaction": "'Level ' || CAST(es AS VARCHAR)",
        "Work-life balance": "'Level ' || CAST(wlb AS VARCHAR)",
        "Job involvement": "'Level ' || CAST(ji AS VARCHAR)",
        "Overtime": _OVERTIME,
        "Business travel": "travel",
        "Marital status": "marital",
        "Stock option level": "'Level ' || CAST(stock AS VARCHAR)",
    }
    union = _long(
        "analysis", segments, "count(*) AS headcount, CAST(sum(leaver) AS BIGINT) AS leavers", "driver", "level"
    )
    return f"SELECT *, round(100.0::DOUBLE * leavers / headcount, 1) AS attrition_pct FROM ({union})"


_REASONS = """SELECT reason AS reason_code, count(*) AS spells, round(sum(hours), 0) AS absence_hours,
    round(100.0::DOUBLE * sum(hours) / (SELECT sum(hours) FROM spells), 1) AS pct_of_hours
    FROM spells GROUP BY reason"""

_MOVEMENT = """SELECT c.ym AS date_key, c.month_start, c.yr AS year, c.mon_name AS month_name,
    (SELECT count(*) FROM employment e WHERE e.hire_ym <= c.ym AND (e.left_ym IS NULL OR e.left_ym > c.ym)) AS active_headcount,
    (SELECT count(*) FROM employment e WHERE e.hire_ym = c.ym) AS hires,
    (SELECT count(*) FROM employment e WHERE e.left_ym = c.ym) AS separations
    FROM calendar c"""

_HEADCOUNT = f"""SELECT *, round(100.0::DOUBLE * separations / nullif(active_headcount, 0), 2) AS monthly_turnover_pct
    FROM ({_MOVEMENT} WHERE c.ym >= 199909)"""

_MONTHLY = """SELECT c.ym AS date_key, c.month_start, c.yr AS year, c.mon_name AS month_name,
    count(*) AS spells, round(sum(s.hours), 0) AS absence_hours
    FROM spells s JOIN calendar c ON c.month_start = CAST(date_trunc('month', s.day) AS DATE)
    GROUP BY ALL"""

_EMPLOYEE = """k AS employee_key, {keys} age, age_band, gender, marital AS marital_status, education,
    field AS education_field, job_level, travel AS business_travel, distance AS distance_from_home,
    distance_band, ot AS overtime, companies AS num_companies_worked, stock AS stock_option_level,
    trainings AS training_times_last_year, js AS job_satisfaction, es AS environment_satisfaction,
    rs AS relationship_satisfaction, wlb AS work_life_balance, ji AS job_involvement,
    rating AS performance_rating, hike AS percent_salary_hike, in_role AS years_in_current_role,
    since_promo AS years_since_last_promotion, with_manager AS years_with_curr_manager"""

_ANALYSIS = f"""SELECT {_EMPLOYEE.format(keys='dept AS department_name, job AS job_role_name,')},
    hired AS hire_date, left_on AS termination_date, stayer AS is_active, leaver AS attrition_flag,
    served AS tenure_days, round(served / 365.25::DOUBLE, 2) AS tenure_years, tenure_band,
    income AS monthly_income, income_band, channel AS source_channel, fill_days AS time_to_fill_days,
    ramp AS ramp_up_days, manager AS hiring_manager_satisfaction, cost AS recruiting_cost,
    exposure AS exposure_days, abs_hours AS absence_hours, abs_days AS absence_days,
    abs_spells AS absence_spells, sched AS scheduled_hours, abs_rate AS absenteeism_rate_pct,
    bradford AS bradford_factor, s_perf AS performance_score, s_stay AS retention_score,
    s_ramp AS ramp_score, s_manager AS hm_satisfaction_score, qoh AS quality_of_hire FROM analysis"""

_FACT_ABSENCE = """SELECT row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey,
        l_shipdate, l_extendedprice) AS absence_key,
    k AS employee_key, day AS absence_date, CAST(year(day) * 100 + month(day) AS INTEGER) AS absence_month_key,
    hours AS absence_hours, days AS absence_days, reason AS reason_code FROM spells"""

_FACT_RECRUITMENT = """SELECT row_number() OVER (ORDER BY k) AS recruitment_key, k AS employee_key,
    channel AS source_channel, hired - fill_days AS req_open_date, hired AS hire_date,
    CAST(year(hired) * 100 + month(hired) AS INTEGER) AS hire_month_key, fill_days AS time_to_fill_days,
    ramp AS ramp_up_days, manager AS hiring_manager_satisfaction, cost AS recruiting_cost FROM hires"""

_FACT_EMPLOYMENT = """SELECT k AS employee_key, dept_id AS department_key, job_id AS job_role_key,
    hired AS hire_date, hire_ym AS hire_month_key, left_on AS termination_date, left_ym AS term_month_key,
    stayer AS is_active, leaver AS attrition_flag, served AS tenure_days,
    round(served / 365.25::DOUBLE, 2) AS tenure_years, tenure_band, income AS monthly_income,
    income_band, rating AS performance_rating FROM employment"""

_SOURCES = f"SELECT * FROM ({_quality()}) WHERE segment_type = 'Source channel'"

_BEST_WORST = f"""SELECT 'best' AS rank, segment AS channel, quality_of_hire AS qoh FROM
    (SELECT * FROM ({_SOURCES}) ORDER BY quality_of_hire DESC, segment LIMIT 1)
    UNION ALL SELECT 'worst', segment, quality_of_hire FROM
    (SELECT * FROM ({_SOURCES}) ORDER BY quality_of_hire, segment LIMIT 1)"""

_HEADLINE = f"""SELECT t.turnover_pct AS annualised_turnover_pct, t.separations,
    t.headcount_current AS active_headcount, a.absenteeism_rate_pct, a.avg_absence_days,
    q.quality_of_hire, q.avg_time_to_fill AS avg_time_to_fill_days,
    b.channel AS best_source, b.qoh AS best_source_qoh, w.channel AS worst_source, w.qoh AS worst_source_qoh
    FROM (SELECT * FROM ({_turnover()}) WHERE segment_type = 'Overall') t,
         (SELECT * FROM ({_absenteeism()}) WHERE segment_type = 'Overall') a,
         (SELECT * FROM ({_quality()}) WHERE segment_type = 'Overall') q,
         (SELECT * FROM ({_BEST_WORST}) WHERE rank = 'best') b,
         (SELECT * FROM ({_BEST_WORST}) WHERE rank = 'worst') w"""

_SUM = "CAST(sum(CAST({0} AS DECIMAL(18, 1))) AS DOUBLE)"
_MEAN = "round(CAST(sum(CAST({0} AS DECIMAL(18, 1))) AS DOUBLE) / nullif(count({0}), 0), 6)"

_TURNOVER_RATE = "sum(leaver) / nullif(sum(stayer) + sum(leaver) / 2.0::DOUBLE, 0)"

_STATUS = f"""CASE WHEN {_TURNOVER_RATE} > 0.2 THEN 'High' WHEN {_TURNOVER_RATE} > 0.12 THEN 'Watch'
    ELSE 'Healthy' END AS turnover_status"""

_MEASURES = f"""count(*) AS headcount, CAST(sum(stayer) AS BIGINT) AS active_headcount,
    CAST(sum(leaver) AS BIGINT) AS separations,
    round(sum(stayer) + sum(leaver) / 2.0::DOUBLE, 6) AS average_headcount,
    round({_TURNOVER_RATE}, 6) AS turnover_rate,
    round(sum(leaver)::DOUBLE / count(*), 6) AS attrition_rate,
    round(1 - sum(leaver)::DOUBLE / count(*), 6) AS retention_rate,
    round(sum(abs_hours), 6) AS absence_hours, round({_SUM.format('sched')}, 6) AS scheduled_hours,
    round(sum(abs_hours) / nullif({_SUM.format('sched')}, 0), 6) AS absenteeism_rate,
    round(sum(abs_days)::DOUBLE / count(*), 6) AS avg_absence_days,
    round(sum(bradford) / count(*), 6) AS avg_bradford_factor,
    {_MEAN.format('qoh')} AS quality_of_hire, {_MEAN.format('s_perf')} AS qoh_performance,
    {_MEAN.format('s_stay')} AS qoh_retention, {_MEAN.format('s_ramp')} AS qoh_ramp,
    {_MEAN.format('s_manager')} AS qoh_hiring_manager, {_MEAN.format('fill_days')} AS avg_time_to_fill,
    {_MEAN.format('ramp')} AS avg_ramp_up_days, CAST(sum(cost) AS BIGINT) AS recruiting_cost,
    round(sum(cost)::DOUBLE / count(*), 6) AS cost_per_hire, {_STATUS}"""

# --- study -----------------------------------------------------------------------------------

_FEATURES = {
    "Monthly income": "income", "Age": "age", "Tenure (years)": "round(served / 365.25::DOUBLE, 2)",
    "Commute distance (km)": "distance", "Years since last promotion": "since_promo",
    "Prior employers": "companies", "Training sessions last year": "trainings",
}

_MOMENTS = " UNION ALL ".join(
    f"""SELECT '{name}' AS feature,
    count(*) FILTER (leaver = 1) AS n1, avg({x}::DOUBLE) FILTER (leaver = 1) AS m1, stddev_samp({x}::DOUBLE) FILTER (leaver = 1) AS s1,
    count(*) FILTER (leaver = 0) AS n0, avg({x}::DOUBLE) FILTER (leaver = 0) AS m0, stddev_samp({x}::DOUBLE) FILTER (leaver = 0) AS s0
    FROM analysis"""
    for name, x in _FEATURES.items()
)

_WELCH = f"""SELECT *, (m1 - m0) / sqrt(s1 * s1 / n1 + s0 * s0 / n0) AS t,
    power(s1 * s1 / n1 + s0 * s0 / n0, 2) / (power(s1 * s1 / n1, 2) / (n1 - 1) + power(s0 * s0 / n0, 2) / (n0 - 1)) AS df,
    (m1 - m0) / sqrt(((n1 - 1) * s1 * s1 + (n0 - 1) * s0 * s0) / (n1 + n0 - 2)) AS d
    FROM ({_MOMENTS})"""

# Two-sided tail of t by Simpson's rule after t = sqrt(df) * tan(angle), which has finite ends.
_T_TAIL = f"""SELECT feature, max(m1) AS m1, max(m0) AS m0, max(t) AS t, max(df) AS df, max(d) AS d,
    2 * exp(lgamma((max(df) + 1) / 2) - lgamma(max(df) / 2)) / sqrt(pi())
      * sum(CASE WHEN i IN (0, 4000) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END
            * power(greatest(cos(lo + (pi() / 2 - lo) * i / 4000), 0), df - 1) * (pi() / 2 - lo) / 4000 / 3) AS p
    FROM (SELECT *, atan(abs(t) / sqrt(df)) AS lo FROM ({_WELCH})), (SELECT unnest(generate_series(0, 4000)) AS i)
    GROUP BY feature"""

_CONTINUOUS = f"""SELECT feature, round(m1, 2) AS mean_leavers, round(m0, 2) AS mean_stayers, round(d, 3) AS cohens_d,
    CASE WHEN abs(d) < 0.2 THEN 'negligible' WHEN abs(d) < 0.5 THEN 'small' WHEN abs(d) < 0.8 THEN 'medium'
         ELSE 'large' END AS effect,
    round(p, 5) AS p_value, p < 0.05 AS significant FROM ({_T_TAIL})"""

_TESTED = {
    "Overtime": "ot", "Business travel": "travel", "Marital status": "marital", "Job satisfaction": "js",
    "Environment satisfaction": "es", "Work-life balance": "wlb", "Job involvement": "ji",
    "Stock option level": "stock",
}

_TABLES = " UNION ALL ".join(
    f"""SELECT '{name}' AS driver, CAST({x} AS VARCHAR) AS level, CAST(sum(leaver) AS BIGINT) AS leavers,
    CAST(sum(stayer) AS BIGINT) AS stayers FROM analysis GROUP BY {x}"""
    for name, x in _TESTED.items()
)

_CHI = f"""SELECT driver, any_value(dof) AS dof, any_value(n) AS n,
    sum(power(abs(o - x) - CASE WHEN dof = 1 THEN least(0.5, abs(o - x)) ELSE 0 END, 2) / x) AS chi2
    FROM (
        SELECT driver, o, n, dof, (leavers + stayers)::DOUBLE * side / n AS x FROM (
            SELECT *, unnest([leavers, stayers]) AS o, unnest([l, s]) AS side FROM (
                SELECT *, sum(leavers) OVER w AS l, sum(stayers) OVER w AS s,
                       sum(leavers + stayers) OVER w AS n, count(*) OVER w - 1 AS dof
                FROM ({_TABLES}) WINDOW w AS (PARTITION BY driver))))
    GROUP BY driver"""

# Tail of chi-square by Simpson's rule over the square root of the variable.
_CHI_TAIL = f"""SELECT driver, any_value(dof) AS dof, any_value(n) AS n, any_value(chi2) AS chi2,
    sum(CASE WHEN i IN (0, 8000) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END
        * power(lo + 0.005 * i, dof - 1) * exp(-power(lo + 0.005 * i, 2) / 2) * 0.005 / 3)
      * 2 / power(2, any_value(dof) / 2.0::DOUBLE) / gamma(any_value(dof) / 2.0::DOUBLE) AS p
    FROM (SELECT *, sqrt(chi2) AS lo FROM ({_CHI})), (SELECT unnest(generate_series(0, 8000)) AS i)
    GROUP BY driver"""

_CATEGORICAL = f"""SELECT driver, round(chi2, 2) AS chi2, CAST(dof AS INTEGER) AS dof, round(sqrt(chi2 / n), 3) AS cramers_v,
    CASE WHEN sqrt(chi2 / n) < 0.1 THEN 'negligible' WHEN sqrt(chi2 / n) < 0.3 THEN 'small'
         WHEN sqrt(chi2 / n) < 0.5 THEN 'medium' ELSE 'large' END AS effect,
    round(p, 5) AS p_value, p < 0.05 AS significant FROM ({_CHI_TAIL})"""

# --- regression ------------------------------------------------------------------------------

_TERMINATIONS = f"""SELECT p.k AS "EmployeeNumber", greatest({AS_OF} - CAST(('0x' || substr(md5(CAST(p.k AS VARCHAR)), 1, 8))::BIGINT % 365 AS INTEGER),
    h.hired + 14) AS termination_date FROM people p JOIN hires h ON h.k = p.k WHERE h.last_day < {AS_OF} - 180"""

_DESIGN = {
    "intercept": "1", "overtime": "ot", "business_travel=Travel_Frequently": "CAST(travel = 'Travel_Frequently' AS INTEGER)",
    "business_travel=Travel_Rarely": "CAST(travel = 'Travel_Rarely' AS INTEGER)", "marital_status=Divorced": "CAST(marital = 'Divorced' AS INTEGER)",
    "marital_status=Single": "CAST(marital = 'Single' AS INTEGER)", "job_satisfaction": "js", "environment_satisfaction": "es",
    "work_life_balance": "wlb", "job_involvement": "ji", "age": "age", "monthly_income_k": "income / 1000.0::DOUBLE",
    "distance_from_home": "distance", "years_since_last_promotion": "since_promo", "num_companies_worked": "companies",
    "stock_option_level": "stock", "tenure_years": "round(served / 365.25::DOUBLE, 2)",
}

# At the maximum of the likelihood the fitted sums are the observed ones.
_CALIBRATION = " UNION ALL ".join(
    f"SELECT '{term}' AS term, round(sum(leaver * {x})::DOUBLE, 3) AS observed, round(sum(leaver * {x})::DOUBLE, 3) AS fitted FROM analysis"
    for term, x in _DESIGN.items()
)

# Levels of the one-category models: (model, term, level, reference level) over the column.
_LEVELS = (
    ("overtime", "Works overtime", "CAST(ot AS VARCHAR)", "1", "0"),
    ("business_travel", "Travels frequently", "travel", "Travel_Frequently", "Non-Travel"),
    ("business_travel", "Travels rarely", "travel", "Travel_Rarely", "Non-Travel"),
    ("short_tenure", "short_tenure", "CAST(round(served / 365.25::DOUBLE, 2) < 5.0 AS VARCHAR)", "true", "false"),
    ("long_tenure", "long_tenure", "CAST(round(served / 365.25::DOUBLE, 2) >= 5.5 AS VARCHAR)", "true", "false"),
)



def _contingency_odds(model: str, term: str, x: str, level: str, reference: str) -> str:
    """Log odds and their error of one level; NULL where a cell is empty."""
    cells = f"""SELECT count(*) FILTER ({x} = '{level}' AND leaver = 1) AS a, count(*) FILTER ({x} = '{level}' AND leaver = 0) AS b,
          count(*) FILTER ({x} = '{reference}' AND leaver = 1) AS c, count(*) FILTER ({x} = '{reference}' AND leaver = 0) AS d FROM analysis"""
    return f"""SELECT '{model}' AS model, '{term}' AS term, a * b * c * d = 0 AS separated,
        CASE WHEN a * b * c * d > 0 THEN ln(a::DOUBLE * d / greatest(b * c, 1)) END AS beta,
        CASE WHEN a * b * c * d > 0 THEN sqrt(1.0::DOUBLE / greatest(a, 1) + 1.0::DOUBLE / greatest(b, 1) + 1.0::DOUBLE / greatest(c, 1) + 1.0::DOUBLE / greatest(d, 1)) END AS error
        FROM ({cells}) WHERE a + b > 0"""


_SINGLE = " UNION ALL ".join(_contingency_odds(*level) for level in _LEVELS)

# Two-sided tail of the normal distribution by Simpson's rule from z on.


def _normal_tail(odds: str) -> str:
    return f"""SELECT model, term, any_value(separated) AS separated, any_value(beta) AS beta, any_value(error) AS error,
        sum(CASE WHEN i IN (0, 4000) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END
            * exp(-power(abs(beta) / error + 0.005 * i, 2) / 2) * 0.005 / 3) * sqrt(2 / pi()) AS p
        FROM ({odds}), (SELECT unnest(generate_series(0, 4000)) AS i) GROUP BY model, term"""


_NORMAL_TAIL = _normal_tail(_SINGLE)


def _odds(tail: str) -> str:
    return f"""SELECT model, term, round(exp(beta), 3) AS odds_ratio, round(exp(beta - 1.959964 * error), 3) AS or_low,
        round(exp(beta + 1.959964 * error), 3) AS or_high, coalesce(round(p, 5) < 0.05, false) AS significant, separated FROM ({tail})"""


_SINGLE_ODDS = _odds(_NORMAL_TAIL)

# Steps of tenure: the edges and the reference level.
_STEPS = {"risk": ((3.5, 4.0, 4.3, 4.6, 4.9, 5.2, 5.5), "5.5"), "protective": ((5.0, 5.4, 5.5, 5.6, 5.7, 5.8, 5.9, 6.0), "under")}


def _stepped(model: str) -> str:
    edges, reference = _STEPS[model]
    cases = " ".join(f"WHEN round(served / 365.25::DOUBLE, 2) >= {e}::DOUBLE THEN '{e}'" for e in reversed(edges))
    levels = [level for level in ("under", *map(str, edges)) if level != reference]
    parts = (_contingency_odds(model, f"step={level}", f"(CASE {cases} ELSE 'under' END)", level, reference) for level in levels)
    return _odds(_normal_tail(" UNION ALL ".join(parts)))

_SINGLE_P = f"SELECT model, term, round(p, 4) AS p_value FROM ({_NORMAL_TAIL})"

_SINGLE_LIKELIHOODS = " UNION ALL ".join(
    f"""SELECT '{model}' AS model, count(*) - 1 AS dof, sum(part) AS fitted, bool_or(cells = 0) AS separated,
    any_value(whole) AS whole, CAST(any_value(total) AS BIGINT) AS observations
    FROM (SELECT sum(leaver) * sum(stayer) AS cells,
          coalesce(sum(leaver) * ln(nullif(sum(leaver), 0)::DOUBLE / count(*)), 0) + coalesce(sum(stayer) * ln(nullif(sum(stayer), 0)::DOUBLE / count(*)), 0) AS part,
          (SELECT sum(leaver) * ln(sum(leaver)::DOUBLE / count(*)) + sum(stayer) * ln(sum(stayer)::DOUBLE / count(*)) FROM analysis) AS whole,
          (SELECT count(*) FROM analysis) AS total FROM analysis GROUP BY {x})"""
    for model, x in (
        ("overtime", "ot"), ("business_travel", "travel"),
        ("short_tenure", "round(served / 365.25::DOUBLE, 2) < 5.0"), ("long_tenure", "round(served / 365.25::DOUBLE, 2) >= 5.5"),
    )
)

# The tail of chi-square at twice the gain in log-likelihood, as above.
_SINGLE_FIT = f"""SELECT model, any_value(observations) AS observations, round(1 - any_value(fitted) / any_value(whole), 3) AS pseudo_r2_mcfadden,
    round(sum(CASE WHEN i IN (0, 8000) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END
        * power(lo + 0.005 * i, dof - 1) * exp(-power(lo + 0.005 * i, 2) / 2) * 0.005 / 3)
      * 2 / power(2, any_value(dof) / 2.0::DOUBLE) / gamma(any_value(dof) / 2.0::DOUBLE), 6) AS llr_p_value,
    NOT any_value(separated) AS converged, any_value(separated) AS separated
    FROM (SELECT *, sqrt(greatest(2 * (fitted - whole), 0)) AS lo FROM ({_SINGLE_LIKELIHOODS})), (SELECT unnest(generate_series(0, 8000)) AS i) GROUP BY model"""

# --- checks ----------------------------------------------------------------------------------

_SILVER = {
    "dim_department": "SELECT dept_id AS department_key, dept AS department_name FROM departments",
    "dim_job_role": "SELECT job_id AS job_role_key, job AS job_role_name FROM roles",
    "dim_date": "SELECT ym AS date_key, month_start, yr AS year, mon AS month_num, mon_name AS month_name, qtr AS quarter FROM calendar",
    "dim_employee": f"SELECT {_EMPLOYEE.format(keys='dept_id AS department_key, job_id AS job_role_key,')} FROM employee_rows",
    "fact_employment": _FACT_EMPLOYMENT,
    "fact_absence": _FACT_ABSENCE,
    "fact_recruitment": _FACT_RECRUITMENT,
}

_COUNTS = " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS row_count FROM ({sql})" for t, sql in _SILVER.items()
)

_KEYS = (
    ("dim_department", "department_key"), ("dim_department", "department_name"),
    ("dim_job_role", "job_role_key"), ("dim_job_role", "job_role_name"), ("dim_date", "date_key"),
    ("dim_employee", "employee_key"), ("fact_employment", "employee_key"),
    ("fact_absence", "absence_key"), ("fact_recruitment", "recruitment_key"),
)

_UNIQUE = " UNION ALL ".join(
    f"""SELECT '{t}' AS table_name, '{c}' AS column_name, count(*) AS repeated_keys,
    CAST(coalesce(sum(n), 0) AS BIGINT) AS repeated_rows
    FROM (SELECT {c}, count(*) AS n FROM ({_SILVER[t]}) WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) > 1)"""
    for t, c in _KEYS
)

_LINKS = (
    ("dim_employee", "department_key", "dim_department"), ("dim_employee", "job_role_key", "dim_job_role"),
    ("fact_employment", "employee_key", "dim_employee"), ("fact_employment", "department_key", "dim_department"),
    ("fact_employment", "job_role_key", "dim_job_role"), ("fact_absence", "employee_key", "dim_employee"),
    ("fact_recruitment", "employee_key", "dim_employee"),
)

_ORPHANS = " UNION ALL ".join(
    f"""SELECT '{t}' AS table_name, '{c}' AS column_name, '{r}' AS references_table,
    count(DISTINCT {c}) AS orphan_keys, count({c}) AS orphan_rows
    FROM ({_SILVER[t]}) WHERE {c} NOT IN (SELECT {c} FROM ({_SILVER[r]}))"""
    for t, c, r in _LINKS
)

# A build with planted faults: every hundredth employee twice, recruitment rows and absences of nobody.
_FAULTY = {
    **_SILVER,
    "dim_employee": f"{_SILVER['dim_employee']} UNION ALL SELECT * FROM ({_SILVER['dim_employee']}) WHERE employee_key % 100 = 0",
    "fact_employment": f"{_FACT_EMPLOYMENT} UNION ALL SELECT * FROM ({_FACT_EMPLOYMENT}) WHERE employee_key % 100 = 0",
    "fact_absence": f"SELECT * REPLACE (CASE WHEN employee_key % 100 = 13 THEN -employee_key ELSE employee_key END AS employee_key) FROM ({_FACT_ABSENCE})",
    "fact_recruitment": f"""SELECT row_number() OVER (ORDER BY employee_key) AS recruitment_key, employee_key FROM (
        SELECT employee_key FROM ({_FACT_RECRUITMENT}) UNION ALL SELECT -employee_key FROM ({_FACT_RECRUITMENT}) WHERE employee_key % 100 = 7)""",
}

_REFUSED = " UNION ALL ".join(
    [
        f"""SELECT '{t}' AS table_name, '{c}' AS column_name, 'unique' AS rule, CAST(NULL AS VARCHAR) AS references_table,
        CAST({c} AS VARCHAR) AS key, count(*) AS row_count FROM ({_FAULTY[t]}) WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) > 1"""
        for t, c in _KEYS
    ]
    + [
        f"""SELECT '{t}', '{c}', 'reference', '{r}', CAST({c} AS VARCHAR), count(*) FROM ({_FAULTY[t]})
        WHERE {c} NOT IN (SELECT {c} FROM ({_FAULTY[r]}) WHERE {c} IS NOT NULL) GROUP BY {c}"""
        for t, c, r in _LINKS
    ]
    + [f"SELECT table_name, NULL, 'seen', NULL, NULL, row_count FROM ({_COUNTS})"]
)

_BY_DEPARTMENT = """SELECT dept AS department_name, count(*) AS headcount, CAST(sum(leaver) AS BIGINT) AS leavers,
    round(100.0::DOUBLE * sum(leaver) / count(*), 1) AS attrition_pct FROM employment GROUP BY dept"""

_GOLD_COUNTS = {
    "employee_analysis": _ANALYSIS, "kpi_turnover": _turnover(), "kpi_absenteeism": _absenteeism(),
    "absence_by_reason": _REASONS, "absence_monthly": _MONTHLY, "kpi_quality_of_hire": _quality(),
    "headcount_monthly": _HEADCOUNT, "attrition_drivers": _drivers(),
}

_SELECTS = {
    **_SILVER,
    "absence_per_employee": "SELECT k AS employee_key, hours AS absence_hours, days AS absence_days, spells AS absence_spells FROM absent",
    "employee_analysis": _ANALYSIS,
    "employee_analysis_star": _ANALYSIS,
    "kpi_turnover": _turnover(),
    "kpi_turnover_trailing_year": _turnover().replace(
        "sum(leaver)", f"sum(CASE WHEN left_on > {AS_OF} - 365 THEN leaver ELSE 0 END)"
    ),
    "kpi_absenteeism": _absenteeism(),
    "kpi_quality_of_hire": _quality(),
    "attrition_drivers": _drivers(),
    "absence_by_reason": _REASONS,
    "absence_monthly": _MONTHLY,
    "headcount_monthly": _HEADCOUNT,
    "headcount_point_in_time": f"SELECT date_key, month_start, active_headcount FROM ({_MOVEMENT})",
    "headcount_at_month_by_department": """SELECT dept AS department_name, count(*) FILTER (
        hire_ym <= 200012 AND (left_ym IS NULL OR left_ym > 200012)) AS active_headcount FROM analysis GROUP BY dept""",
    "attrition_by_department": _BY_DEPARTMENT,
    "best_worst_source": _BEST_WORST,
    "headline": _HEADLINE,
    "warehouse_headline": _HEADLINE,
    "turnover_by_department": f"SELECT segment, turnover_pct FROM ({_turnover()}) WHERE segment_type = 'Department'",
    "quality_by_channel": f"SELECT segment, quality_of_hire, avg_time_to_fill FROM ({_SOURCES})",
    "measures_overall": f"SELECT {_MEASURES} FROM analysis",
    "measures_by_department": f"SELECT dept AS department_name, {_MEASURES} FROM analysis GROUP BY dept",
    "measures_filtered": f"SELECT age_band, gender, {_MEASURES} FROM analysis WHERE ot = 1 GROUP BY age_band, gender",
    "turnover_status": f"SELECT tenure_band, round({_TURNOVER_RATE}, 6) AS turnover_rate, {_STATUS} FROM analysis GROUP BY tenure_band",
    "absence_trend": f"SELECT date_key, month_start, h AS absence_hours FROM (SELECT c.ym AS date_key, c.month_start, sum(s.hours) AS h FROM spells s JOIN calendar c ON c.ym = year(s.day) * 100 + month(s.day) GROUP BY ALL)",
    "measures_with_subtotals": f"""SELECT dept AS department_name, job AS job_role_name, CAST(GROUPING(dept, job) AS INTEGER) AS grouping, {_MEASURES}
        FROM analysis GROUP BY CUBE (dept, job)""",
    "measures_grouping_sets": f"""SELECT age_band, gender, ot AS overtime, CAST(GROUPING(age_band, gender, ot) AS INTEGER) AS grouping, count(*) AS headcount,
        round({_TURNOVER_RATE}, 6) AS turnover_rate, round(sum(bradford) / count(*), 6) AS avg_bradford_factor
        FROM analysis WHERE stayer = 1 GROUP BY GROUPING SETS ((age_band, gender), (ot), ())""",
    "absence_trend_filtered": """SELECT c.ym AS date_key, c.month_start, e.dept AS department_name, sum(s.hours) AS absence_hours
        FROM spells s JOIN analysis e ON e.k = s.k JOIN calendar c ON c.ym = year(s.day) * 100 + month(s.day) WHERE e.ot = 1 GROUP BY ALL""",
    "absence_trend_of_some": """SELECT c.ym AS date_key, c.month_start, sum(s.hours) AS absence_hours FROM spells s JOIN calendar c
        ON c.ym = year(s.day) * 100 + month(s.day) WHERE s.days >= 3 AND s.k IN (SELECT k FROM analysis WHERE gender = 'Female' AND stayer = 1) GROUP BY ALL""",
    "contingency": _TABLES,
    "chi_square": f"SELECT driver, CAST(n AS BIGINT) AS n, CAST(dof AS BIGINT) AS dof, round(chi2, 6) AS chi2, round(sqrt(chi2 / n), 6) AS cramers_v FROM ({_CHI})",
    "categorical_tests": _CATEGORICAL,
    "grouped_moments": f"SELECT feature, n1 AS n_leavers, round(m1, 6) AS mean_leavers, round(s1, 6) AS sd_leavers, n0 AS n_stayers, round(m0, 6) AS mean_stayers, round(s0, 6) AS sd_stayers FROM ({_MOMENTS})",
    "welch_t": f"SELECT feature, round(t, 6) AS t, round(df, 4) AS df, round(d, 6) AS cohens_d FROM ({_WELCH})",
    "continuous_tests": _CONTINUOUS,
    "terminations_hashed": _TERMINATIONS,
    "logistic_calibration": _CALIBRATION,
    "single_term_odds": _SINGLE_ODDS,
    "single_term_p_values": _SINGLE_P,
    "single_term_fit": _SINGLE_FIT,
    "single_term_top_risk": f"SELECT * EXCLUDE (model) FROM ({_SINGLE_ODDS}) WHERE odds_ratio > 1 AND significant ORDER BY odds_ratio DESC, term LIMIT 6",
    "single_term_top_protective": f"SELECT * EXCLUDE (model) FROM ({_SINGLE_ODDS}) WHERE odds_ratio < 1 AND significant ORDER BY odds_ratio, term LIMIT 6",
    "stepped_odds": f"{_stepped('risk')} UNION ALL {_stepped('protective')}",
    "stepped_top_risk": f"SELECT * EXCLUDE (model) FROM ({_stepped('risk')}) WHERE odds_ratio > 1 AND significant ORDER BY odds_ratio DESC, term LIMIT 6",
    "stepped_top_protective": f"SELECT * EXCLUDE (model) FROM ({_stepped('protective')}) WHERE odds_ratio < 1 AND significant ORDER BY odds_ratio, term LIMIT 6",
    "separated_terms": """SELECT term, CAST(NULL AS DOUBLE) AS odds_ratio, true AS separated, (SELECT count(*) FROM analysis) AS observations, true AS model_separated
        FROM (VALUES ('level=left'), ('end')) AS t(term)""",
    "single_term_feed": f"""SELECT term, odds_ratio, or_low, or_high, CASE WHEN NOT significant THEN 'not significant'
        WHEN odds_ratio > 1 THEN 'risk' ELSE 'protective' END AS kind FROM ({_SINGLE_ODDS})""",
    "warehouse_bucketed_analysis": _ANALYSIS,
    "feed_driver_levels": f"SELECT driver, level, attrition_pct FROM ({_drivers()}) WHERE driver IN ('Job satisfaction', 'Work-life balance', 'Overtime')",
    "feed_one_driver": f"SELECT level, attrition_pct FROM ({_drivers()}) WHERE driver = 'Overtime'",
    "feed_department_turnover": f"SELECT segment, turnover_pct FROM ({_turnover()}) WHERE segment_type = 'Department'",
    "feed_channel_quality": f"SELECT segment, quality_of_hire, avg_time_to_fill FROM ({_SOURCES})",
    "feed_headcount": f"SELECT date_key, month_start, active_headcount, separations FROM ({_HEADCOUNT})",
    "feed_absence_reason": f"SELECT reason_code, absence_hours FROM ({_REASONS})",
    "quality_unique": _UNIQUE,
    "quality_orphans": _ORPHANS,
    "quality_counts": _COUNTS,
    "publish_refused": _REFUSED,
    "document_kpis": _HEADLINE,
    "document_regression": f"""SELECT f.observations, f.pseudo_r2_mcfadden, f.converged, o.* EXCLUDE (model, separated)
        FROM ({_SINGLE_ODDS}) o JOIN ({_SINGLE_FIT}) f ON f.model = o.model WHERE o.model = 'long_tenure'""",
    "document_continuous_tests": _CONTINUOUS,
    "document_categorical_tests": _CATEGORICAL,
    "csv_turnover": _turnover(),
    "csv_absence_by_reason": _REASONS,
    "csv_tolerant_turnover": _turnover(),
    "csv_rejects": """SELECT 'employees' AS table_name, 'unknown' || repeat(',', 9) || c_custkey || repeat(',', 25) AS line FROM customer WHERE c_custkey % 20 = 0
        UNION ALL SELECT 'absence', '0,' || c_custkey || ',no date,7.5,1,Broken' FROM customer WHERE c_custkey % 50 = 0
        UNION ALL SELECT 'recruitment', c_custkey || ',Broken' FROM customer WHERE c_custkey % 70 = 0""",
    "warehouse_turnover": _turnover(),
    "warehouse_counts": " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS row_count FROM ({sql})" for t, sql in _GOLD_COUNTS.items()
    ),
    "export_gold_csv": _quality(),
    "export_star_csv": _FACT_EMPLOYMENT,
}


def statements() -> dict[str, str]:
    return {name: f"{_BASE} {select}" for name, select in _SELECTS.items()}
