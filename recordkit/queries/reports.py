"""The whole reports on the derived model, each with SQL written apart from the Spark code."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from recordkit.operators.tickets import GivenWeeks, TicketColumns, Week, channel_counts, daily_partials, mean_duration, measures_in_contexts, related, week_over_week
from recordkit.operators.uploads import rejects
from recordkit.plans.answer_sheet import answer_rows
from recordkit.plans.gpa_audit import AuditRun, gpa_audit
from recordkit.plans.reconciliation import ReconciliationRun, reconciliation
from recordkit.plans.scale_update import publish_scale_update, scale_update
from recordkit.plans.student_extract import ExtractRun, student_extract
from recordkit.queries.registry import SQL, query
from recordkit.queries.sis import model, model_sql
from recordkit.sources.tables import new_folder
from recordkit.sources.versions import create_version, version

REPORT_WEEK = Week(dt.date(2024, 1, 29))

# ---------------------------------------------------------------- student extract


def _newest_score(where: str) -> str:
    return f"""(
        SELECT a.student_id, t.title, s.test_code, s.score
        FROM test_history_scores s
        JOIN test_history_administrations a ON a.id = s.administration_id AND a.test_id = s.test_id
        JOIN test_history_tests t ON t.id = s.test_id
        JOIN test_history_parts p ON p.id = s.part_id AND p.test_id = s.test_id
        LEFT JOIN test_history_score_types y ON y.id = s.score_type_id
        WHERE {where}
        QUALIFY row_number() OVER (PARTITION BY a.student_id ORDER BY a.administration_date DESC NULLS FIRST, a.id, t.title NULLS FIRST,
            p.id, s.score NULLS FIRST, s.test_code NULLS FIRST) = 1)"""


def _band(code: str) -> str:
    return f"nullif(list_position(['Inadequate', 'Below Satisfactory', 'Satisfactory', 'Proficient', 'Mastery'], {code}), 0)::INTEGER"


def _gain(later: str, earlier: str) -> str:
    return f"(try_cast({later} AS BIGINT) - try_cast({earlier} AS BIGINT))"


EXTRACT_SQL = f"""
WITH {model_sql("students", "custom_field_select_options", "student_enrollment", "schools", "school_gradelevels", "marking_periods",
    "attendance_day", "discipline_referrals", "test_history_tests", "test_history_parts", "test_history_score_types",
    "test_history_administrations", "test_history_scores", "benchmark_ia1_to_ia4_temp", "iready_math_upload_temp")},
spine AS (
    SELECT s.*, g.title AS grade
    FROM student_enrollment e
    JOIN students s USING (student_id)
    JOIN schools c ON c.id = e.school_id
    JOIN school_gradelevels g ON g.id = e.grade_id
    JOIN marking_periods p ON p.school_id = e.school_id AND p.syear = e.syear AND p.short_name = 'FY'
    WHERE e.syear = 2021 AND c.custom_327 IN ('0051', '0101', '0291') AND (e.end_date IS NULL OR e.end_date <= p.end_date)
    QUALIFY row_number() OVER (PARTITION BY e.student_id ORDER BY e.end_date DESC NULLS FIRST, e.start_date, e.school_id, e.grade_id) = 1),
days AS (SELECT student_id, sum(state_value)::BIGINT AS present, count(state_value) AS total FROM attendance_day WHERE syear = 2021 GROUP BY ALL),
referral AS (SELECT student_id, count(DISTINCT referral_id) AS referrals FROM discipline_referrals WHERE syear = 2021 GROUP BY ALL)
SELECT spine.student_id - {4300000000 + 200420} AS "Student ID", 'Martin County Elementary School' AS "School", grade AS "Grade",
    (SELECT regexp_replace(label, '[FM] - ', '', 'g') FROM custom_field_select_options WHERE id = custom_200000000) AS "Gender",
    (SELECT regexp_replace(label, ', Non-Hispanic|Other-', '', 'g') FROM custom_field_select_options WHERE id = custom_200000001) AS "Race",
    CASE WHEN custom_626 IN (21, 22, 23) THEN 'Yes' ELSE 'No' END AS "ELL",
    CASE WHEN starts_with(coalesce(custom_2012197500, 'L - '), 'L - ') THEN 'No' ELSE 'Yes' END AS "ESE",
    CASE WHEN "Student ID" % 10 IN (0, 2, 4, 6, 8, 7, 9) THEN 'Yes' ELSE 'No' END AS "FRL",
    present::DOUBLE AS "Days Present", total AS "Days Total",
    CASE WHEN total > 0 THEN (present * 20000 + total) // (2 * total) / 100.0 END AS "Attendance Rate",
    ("Attendance Rate" < 90)::INTEGER AS "Below 90 Percent Attendance",
    referrals AS "Referrals", (referrals IS NOT NULL)::INTEGER AS "Has Referral",
    fe.score AS "Last FSA ELA AL", (fe.score >= 3)::INTEGER AS "Passed FSA ELA",
    ae.title AS "Last APM ELA Test Name", ae.test_code AS "Last APM ELA Proficiency Level Desc", {_band("ae.test_code")} AS "Last APM ELA Proficiency Level",
    ia1_p1 AS "Benchmark IA1 Score", ia4_p1 AS "Benchmark IA4 Score", {_gain("ia4_p1", "ia1_p1")} AS "Benchmark IA Growth",
    ("Benchmark IA Growth" > 0)::INTEGER AS "Made Benchmark IA Growth",
    fm.score AS "Last FSA Math AL", (fm.score >= 3)::INTEGER AS "Passed FSA Math",
    am.title AS "Last APM Math Test Name", am.test_code AS "Last APM Math Proficiency Level Desc", {_band("am.test_code")} AS "Last APM Math Proficiency Level",
    fall_ss AS "i-Ready Math Fall SS", spring_ss AS "i-Ready Math Spring SS", {_gain("spring_ss", "fall_ss")} AS "i-Ready Math SS Growth",
    spring_pr AS "i-Ready Math Spring Percentile", spring_rp AS "i-Ready Math Spring Placement",
    ("i-Ready Math SS Growth" > 0)::INTEGER AS "Made i-Ready Math Growth"
FROM spine
LEFT JOIN days USING (student_id)
LEFT JOIN referral USING (student_id)
LEFT JOIN {_newest_score("t.title LIKE '%FSA ELA%' AND y.short_name = 'AL'")} fe USING (student_id)
LEFT JOIN {_newest_score("lower(t.title) LIKE '%fsa math%' AND y.short_name = 'AL'")} fm USING (student_id)
LEFT JOIN {_newest_score("t.title LIKE 'APM%' AND NOT contains(t.title, 'Summer') AND p.title = 'Math Proficiency'")} am USING (student_id)
LEFT JOIN {_newest_score("t.title LIKE 'APM%' AND NOT contains(t.title, 'Summer') AND p.title = 'Reading Proficiency'")} ae USING (student_id)
LEFT JOIN benchmark_ia1_to_ia4_temp b ON b.student_id = spine.student_id::VARCHAR
LEFT JOIN iready_math_upload_temp i ON i.student_id = spine.student_id::VARCHAR
"""


@query("student_extract", EXTRACT_SQL)
def _student_extract(spark: SparkSession, folder: str) -> DataFrame:
    return student_extract(model(spark, folder), ExtractRun("Martin County Elementary School", (4300000000, 200420)))


# ---------------------------------------------------------------- scale update

COURSES_SQL = f"""
WITH {model_sql("student_report_card_grades", "report_card_grade_scales", "marking_periods")},
history AS (
    SELECT g.*, m.title AS mp FROM student_report_card_grades g JOIN marking_periods m ON m.marking_period_id::VARCHAR = g.marking_period_id
    WHERE course_history = 'Y' AND affects_gpa = 'Y' AND credits <> 0 AND g.syear = 2021),
offered AS (
    SELECT grade_scale_id, CASE WHEN course_num LIKE '79%' THEN 'Weight 4 Below Level' ELSE coalesce(map {{
        'Weight 5 AP IB AICE DE': 'Weight 7 AP DE IB', 'Weight 4.5 Honors & Advanced': 'Weight 6 Honors & Advanced',
        'Weight 4 On Level': 'Weight 5 On Level'}}[title], title) END AS target, count(*) AS n
    FROM history JOIN report_card_grade_scales r ON r.id = grade_scale_id WHERE custom_7 IN ('10', '11', '12') GROUP BY ALL),
titles AS (
    SELECT grade_scale_id, first(target ORDER BY n DESC, target) AS target, count(*) AS choices FROM offered GROUP BY 1),
scales AS (SELECT id, coalesce(target, title) AS title FROM report_card_grade_scales LEFT JOIN titles ON id = grade_scale_id),
pointed AS (
    SELECT h.*, r.title AS grade_scale, CASE
        WHEN r.title IN ('Weight 7 AP DE IB', 'Weight 6 Honors & Advanced', 'Weight 5 On Level', 'Weight 4 Below Level') AND grade_title IN ('A', 'B', 'C', 'D')
            THEN substr(r.title, 8, 1)::INTEGER - (ascii(grade_title) - ascii('A'))
        WHEN grade_title IN ('F', 'P', 'T', 'I', 'W', 'WP') THEN 0 ELSE 99 END AS points
    FROM history h JOIN scales r ON r.id = grade_scale_id WHERE custom_7 IN ('10', '11', '12')),
choices AS (
    SELECT student_id, syear, course_num, course_title, custom_7, marking_period_id, report_card_grade_id, points, count(*) AS n FROM pointed GROUP BY ALL),
chosen AS (
    SELECT student_id, syear, course_num, course_title, custom_7, marking_period_id, report_card_grade_id,
        first(points ORDER BY n DESC, points) AS points, count(*) AS choices FROM choices GROUP BY ALL)
"""

GRADE_KEY = "student_id, syear, course_num, course_title, custom_7, marking_period_id, report_card_grade_id"


@query("scale_update_scales", COURSES_SQL + "SELECT id, title FROM scales")
def _scales(spark: SparkSession, folder: str) -> DataFrame:
    return scale_update(model(spark, folder)).report_card_grade_scales


@query(
    "scale_update_grades",
    COURSES_SQL
    + f"""SELECT {GRADE_KEY}, coalesce(points, weighted_gpa_points)::DOUBLE AS weighted_gpa_points
    FROM student_report_card_grades LEFT JOIN chosen USING ({GRADE_KEY})""",
)
def _grades(spark: SparkSession, folder: str) -> DataFrame:
    return scale_update(model(spark, folder)).student_report_card_grades.select(*GRADE_KEY.split(", "), "weighted_gpa_points")


@query(
    "scale_update_staged_titles",
    COURSES_SQL
    + """SELECT student_id, syear, school_id, course_title, course_num, credits::DOUBLE AS credits, credits_earned::DOUBLE AS credits_earned,
        grade_title, r.title AS grade_scale, grade_scale_id,
        CASE WHEN course_num LIKE '79%' THEN 'Weight 4 Below Level' WHEN r.title LIKE 'Weight 5 AP%' THEN 'Weight 7 AP DE IB'
             WHEN r.title LIKE 'Weight 4.5%' THEN 'Weight 6 Honors & Advanced' WHEN r.title = 'Weight 4 On Level' THEN 'Weight 5 On Level'
             ELSE r.title END AS seven_scale_value,
        custom_7 AS grade, mp, updated_at::VARCHAR AS updated_at
    FROM history JOIN report_card_grade_scales r ON r.id = grade_scale_id""",
)
def _staged_titles(spark: SparkSession, folder: str) -> DataFrame:
    return scale_update(model(spark, folder)).course_history_update


@query("scale_update_unmapped", COURSES_SQL + "SELECT grade_scale, grade_title, count(*) AS courses FROM pointed WHERE points = 99 GROUP BY ALL")
def _unmapped(spark: SparkSession, folder: str) -> DataFrame:
    rows = scale_update(model(spark, folder)).unmapped
    return rows.groupBy("grade_scale", "grade_title").agg(F.count(F.lit(1)).alias("courses"))


@query(
    "scale_update_staged_points",
    COURSES_SQL
    + """SELECT student_id, syear, school_id, marking_period_id, report_card_grade_id, course_title, course_num, credits::DOUBLE AS credits,
        credits_earned::DOUBLE AS credits_earned, grade_title, grade_scale, weighted_gpa_points::DOUBLE AS weighted_gpa_points,
        points AS updated_weighted_gpa_points, custom_7 AS grade FROM pointed""",
)
def _staged_points(spark: SparkSession, folder: str) -> DataFrame:
    return scale_update(model(spark, folder)).course_history_weighted_gpa_points_update


@query(
    "scale_update_grade_conflicts",
    COURSES_SQL
    + """SELECT student_id, syear, course_num, course_title, marking_period_id, report_card_grade_id, custom_7 AS grade,
        points AS updated_weighted_gpa_points, choices FROM chosen WHERE choices > 1""",
)
def _grade_conflicts(spark: SparkSession, folder: str) -> DataFrame:
    return scale_update(model(spark, folder)).grade_conflicts


@query("scale_update_conflicts", COURSES_SQL + "SELECT grade_scale_id, target AS seven_scale_value, choices FROM titles WHERE choices > 1")
def _conflicts(spark: SparkSession, folder: str) -> DataFrame:
    return scale_update(model(spark, folder)).scale_conflicts


def _published(spark: SparkSession, folder: str) -> str:
    """Store the model's scales and grades, run the scale update on them, and give the folder of both tables."""
    sis, root = model(spark, folder), new_folder(spark, "published")
    scales = create_version(sis["report_card_grade_scales"], f"{root}/scales")
    grades = create_version(sis["student_report_card_grades"], f"{root}/grades", by=["syear", "student_id"])
    publish_scale_update(scales, grades, sis["marking_periods"])
    return root


@query("published_scales", COURSES_SQL + "SELECT id, title FROM scales")
def _published_scales(spark: SparkSession, folder: str) -> DataFrame:
    return version(spark, f"{_published(spark, folder)}/scales").read(spark)


@query("published_grades", SQL["scale_update_grades"])
def _published_grades(spark: SparkSession, folder: str) -> DataFrame:
    grades = version(spark, f"{_published(spark, folder)}/grades").read(spark)
    return grades.select(*GRADE_KEY.split(", "), "weighted_gpa_points")


# ---------------------------------------------------------------- GPA audit

GPA_SQL = f"""
WITH {model_sql("students", "student_enrollment", "schools", "school_gradelevels", "marking_periods", "student_report_card_grades", "report_card_grade_scales")},
courses AS (
    SELECT g.*, CASE WHEN syear < 2021 THEN NULL WHEN r.title = 'Weight 5 AP IB AICE DE' THEN 7 WHEN r.title = 'Weight 4.5 Honors & Advanced' THEN 6
        WHEN r.title = 'Weight 4 On Level' THEN 5 END AS remapped, try_cast(substr(r.title, 8, 1) AS INTEGER) AS own
    FROM student_report_card_grades g JOIN report_card_grade_scales r ON r.id = grade_scale_id
    WHERE course_history = 'Y' AND affects_gpa = 'Y' AND credits <> 0),
pointed AS (
    SELECT *, CASE WHEN coalesce(remapped, own) IN (4, 5, 6, 7) AND grade_title IN ('A', 'B', 'C', 'D')
            THEN coalesce(remapped, own) - (ascii(grade_title) - ascii('A'))
        WHEN grade_title IN ('F', 'P', 'T', 'W') THEN 0 ELSE 99 END AS old_points
    FROM courses),
placed AS (
    SELECT e.student_id, c.title AS school, l.title AS grade_level
    FROM student_enrollment e JOIN students s ON s.student_id = e.student_id JOIN schools c ON c.id = e.school_id
    JOIN school_gradelevels l ON l.id = e.grade_id JOIN marking_periods m ON m.school_id = e.school_id AND m.syear = e.syear AND m.short_name = 'FY'
    WHERE e.syear = 2021 AND date_diff('day', coalesce(e.end_date, m.end_date), m.end_date) BETWEEN 0 AND 10 AND {{chosen}}),
sums AS (
    SELECT student_id, school, grade_level, sum(credits) AS c, sum(credits_earned) AS e, sum(round(credits_earned * gpa_points, 3)) AS u,
        sum(round(credits_earned * old_points, 3)) AS o, sum(round(credits_earned * weighted_gpa_points, 3)) AS w
    FROM placed JOIN pointed USING (student_id) GROUP BY ALL),
scaled AS (
    SELECT *, (c * 10000)::BIGINT AS ci, ((u * 10000)::BIGINT::HUGEINT * 20000 + ci) // (2 * ci) AS ug,
        ((o * 10000)::BIGINT::HUGEINT * 20000 + ci) // (2 * ci) AS og, ((w * 10000)::BIGINT::HUGEINT * 20000 + ci) // (2 * ci) AS wg
    FROM sums),
ranked AS (
    SELECT *, rank() OVER (PARTITION BY school, grade_level ORDER BY og DESC NULLS FIRST) AS a_rank,
        rank() OVER (PARTITION BY school, grade_level ORDER BY wg DESC NULLS FIRST) AS c_rank, count(*) OVER (PARTITION BY school, grade_level) AS n
    FROM scaled)
SELECT student_id AS "Student ID", school AS "School", grade_level AS "Grade Level", c::DOUBLE AS "Credits Attempted", e::DOUBLE AS "Credits Earned",
    u::DOUBLE AS "Unweighted Quality Points", o::DOUBLE AS "Adjusted Quality Points", w::DOUBLE AS "Current Quality Points",
    ug::DOUBLE / 10000 AS "Unweighted GPA", og::DOUBLE / 10000 AS "Adjusted Weighted GPA", wg::DOUBLE / 10000 AS "Current Weighted GPA",
    a_rank AS "Adjusted Class Rank", c_rank AS "Current Class Rank", abs(c_rank - a_rank) AS "Class Rank Change",
    ((a_rank * 20000 + n) // (2 * n))::DOUBLE / 100 AS "Adjusted Percentile", ((c_rank * 20000 + n) // (2 * n))::DOUBLE / 100 AS "Current Percentile"
FROM ranked
"""


@query("gpa_audit", GPA_SQL.replace("{chosen}", "l.title IN ('09', '10', '11', '12')"))
def _gpa_audit(spark: SparkSession, folder: str) -> DataFrame:
    return gpa_audit(model(spark, folder))


@query("gpa_audit_one_school", GPA_SQL.replace("{chosen}", "l.title = '10' AND c.id = 5"))
def _gpa_audit_one_school(spark: SparkSession, folder: str) -> DataFrame:
    return gpa_audit(model(spark, folder), AuditRun(school_id=5, grades="10"))


# ---------------------------------------------------------------- answer sheet


def _capitals(text: str) -> str:
    return f"array_to_string([upper(w[1]) || lower(w[2:]) for w in regexp_extract_all({text}, '[A-Za-z0-9]+|[^A-Za-z0-9]+')], '')"


_QUESTIONS = ", ".join(f"'{i:02d}'" for i in range(26))
_ANSWERS = ", ".join(["test_score_", *[f"_{i}" for i in range(1, 26)]])
_ROW = "student_id, custom_327 NULLS FIRST, school_name NULLS FIRST, grade NULLS FIRST, course NULLS FIRST, teacher NULLS FIRST, course_period_id"

SHEET_SQL = f"""
WITH {model_sql("students", "student_enrollment", "schools", "school_gradelevels", "marking_periods", "schedule", "course_periods", "school_periods",
    "courses", "users", "pm_civics_flip_temp", "pm_civics_standards_temp")},
candidates AS (
    SELECT s.student_id, s.last_name, s.first_name, k.custom_327, k.title AS school_name, g.title AS grade, c.title AS course,
        {_capitals("concat(u.last_name, ', ', u.first_name)")} AS teacher, h.course_period_id,
        e.start_date AS es, e.end_date AS ee, h.start_date AS hs, h.end_date AS he
    FROM (SELECT * REPLACE (pm.student_id::BIGINT AS student_id) FROM pm_civics_flip_temp pm) pm
    JOIN students s USING (student_id) JOIN student_enrollment e USING (student_id)
    JOIN schedule h ON h.student_id = e.student_id AND h.syear = e.syear AND h.school_id = e.school_id
    JOIN course_periods cp ON cp.course_period_id = h.course_period_id AND cp.syear = e.syear
    JOIN courses c ON c.course_id = cp.course_id AND c.syear = e.syear
    JOIN schools k ON k.id = e.school_id JOIN school_gradelevels g ON g.id = e.grade_id JOIN school_periods sp ON sp.period_id = cp.period_id
    JOIN users u ON u.staff_id = cp.teacher_id LEFT JOIN marking_periods m ON m.marking_period_id = cp.marking_period_id
    WHERE e.syear = 2021 AND e.custom_9 IS DISTINCT FROM 'Y' AND regexp_matches(c.title, 'civ|hist', 'i')
        AND coalesce(m.short_name, 'S1') = 'S1' AND h.start_date <= DATE '2022-03-07'),
marked AS (
    SELECT *, row_number() OVER (PARTITION BY student_id ORDER BY he DESC NULLS FIRST, {_ROW}, es, ee NULLS FIRST, hs) = 1 AS last_course,
        row_number() OVER (PARTITION BY student_id ORDER BY es DESC NULLS FIRST, {_ROW}, ee NULLS FIRST, hs, he NULLS FIRST) = 1 AS last_started,
        row_number() OVER (PARTITION BY student_id ORDER BY ee DESC NULLS FIRST, {_ROW}, es, hs, he NULLS FIRST) = 1 AS last_ended
    FROM candidates),
general AS (
    SELECT * FROM marked
    WHERE (he IS NULL OR he BETWEEN DATE '2022-03-07' AND DATE '2022-03-11' OR (hs >= DATE '2021-08-11' AND last_course))
      AND ((ee IS NULL AND es <= DATE '2022-03-07') OR (ee BETWEEN DATE '2022-03-07' AND DATE '2022-03-11' AND es <= DATE '2022-03-07' AND last_started)
        OR (es >= DATE '2021-08-11' AND ee IS NOT NULL AND last_ended))),
answered AS (
    SELECT g.*, unnest([{_QUESTIONS}]) AS q, unnest([{_ANSWERS}]) AS v FROM general g JOIN pm_civics_flip_temp f ON f.student_id = g.student_id::VARCHAR)
SELECT '2022' AS school_year, student_id::VARCHAR AS student_id, last_name AS student_last, first_name AS student_first,
    {_capitals("concat(last_name, ', ', first_name)")} AS student_full, lpad(custom_327, 4, '0') AS school_id, school_name, course, teacher,
    grade AS assessment_grade_level, 'Social Studies' AS subject, 'Civics' AS subject_category, 'Civics CQA3' AS test_name, '20220311' AS test_date,
    'Quarter 3' AS time_period, es::VARCHAR AS enrollment_start, CASE WHEN q = '00' THEN 'Overall Score' ELSE q END AS question,
    CASE WHEN q = '00' THEN v END AS score, CASE WHEN q <> '00' THEN v END AS answer, standard, description, reporting_category
FROM answered LEFT JOIN pm_civics_standards_temp n ON lpad(n.question, 2, '0') = q
WHERE q = '00' OR n.question IS NOT NULL
"""


@query("answer_sheet", SHEET_SQL)
def _answer_sheet(spark: SparkSession, folder: str) -> DataFrame:
    return answer_rows(model(spark, folder))


# ---------------------------------------------------------------- reconciliation


def _code(option: str, part: str = "code") -> str:
    return f"(SELECT {part} FROM custom_field_select_options WHERE id = {option})"


def _text_code(option: str) -> str:
    return f"(SELECT code FROM custom_field_select_options WHERE id::VARCHAR = {option})"


def _dated(item: str, extra: str = "") -> str:
    return f"""LEFT JOIN changes {item}_log ON {item}_log.fleid = compared.fleid AND {item}_log.item = '{item}'
        AND compared.{item}_change = 'Y' {extra}"""


def _differs(name: str, left: str, right: str) -> str:
    return f"CASE WHEN {left} <> {right} THEN 'Y' END AS {name}"


_PLAIN_FILE = "record_id, district_of_enrollment, student_last_name, student_first_name, du.fleid, date_of_birth, sex, race, full_year_school, full_year_district, ext_med"
_DATED = ["zoned_district", "zoned_school", "grade_level", "primary_ese_code", "other_ese_code", "ell_code"]
# Fixed values, written here again so that the plan's own are checked.
_LOGGED = {
    "zoned_district": "%CUSTOM_821%", "zoned_school": "%CUSTOM_822%", "grade_level": "%GRADE_ID%",
    "primary_ese_code": "%LOG_FIELD4%", "other_ese_code": "%LOG_FIELD6%", "ell_code": "%CUSTOM_626%",
}
_CHANGES = " UNION ALL ".join(
    f"SELECT fleid, '{item}' AS item, strftime(max(log_time), '%Y%m%d') AS day FROM updates WHERE after LIKE '{pattern}' GROUP BY student_id, fleid"
    for item, pattern in _LOGGED.items()
)
_MET = "CASE WHEN se.grade NOT IN ('10', '11', '12') THEN 'Z' WHEN req IN ('Y', 'YC', 'YW') THEN 'Y' ELSE 'N' END"

RECONCILIATION_SQL = f"""
WITH {model_sql("students", "custom_field_select_options", "student_enrollment", "student_enrollment_codes", "schools", "school_gradelevels",
    "users", "database_object_log", "custom_field_log_entries", "student_data_updates_temp")},
spans AS (
    SELECT s.student_id, s.custom_200000224 AS fleid, e.start_date, e.end_date, d.title AS drop_title, g.title AS grade, c.title AS school, c.custom_327 AS school_num
    FROM student_enrollment e JOIN students s USING (student_id) JOIN schools c ON c.id = e.school_id JOIN school_gradelevels g ON g.id = e.grade_id
    LEFT JOIN student_enrollment_codes d ON d.id = e.drop_code
    WHERE coalesce(e.end_date, DATE '9999-01-01') >= DATE '2022-02-18' AND e.syear = 2021 AND e.custom_9 IS DISTINCT FROM 'Y'),
enrolled AS (
    SELECT DISTINCT * FROM (
        SELECT * FROM spans QUALIFY end_date IS NULL OR row_number() OVER (PARTITION BY student_id ORDER BY end_date DESC NULLS FIRST,
            start_date, drop_title NULLS FIRST, grade, school, school_num) = 1)),
coded AS (
    SELECT r.fleid, CASE WHEN t = 'A' AND log_field12 IS NULL AND log_field4 = 'Y' THEN c END AS prim,
        CASE WHEN t = 'A' AND log_field12 IS NULL AND log_field4 IS DISTINCT FROM 'Y' THEN c END AS oth
    FROM enrolled r LEFT JOIN (SELECT *, {_text_code("log_field6")} AS t, {_text_code("log_field3")} AS c FROM custom_field_log_entries WHERE field_id = 457) e
        ON e.source_id = r.student_id),
ese AS (SELECT fleid, rpad(coalesce(min(prim), ''), 1, 'Z') || rpad(coalesce(string_agg(oth, '' ORDER BY oth), ''), 9, 'Z') AS code FROM coded GROUP BY fleid),
dop AS (
    SELECT DISTINCT r.fleid, {_text_code("log_field1")} AS program, CASE WHEN log_field4::DATE >= DATE '2022-02-18' THEN replace(log_field4, '-', '') END AS started
    FROM enrolled r JOIN custom_field_log_entries e ON e.source_id = r.student_id WHERE field_id = 312 AND log_field2 = 'Y' AND log_field5 IS NULL),
updates AS (
    SELECT l.student_id, s.custom_200000224 AS fleid, after, log_time FROM database_object_log l JOIN students s USING (student_id)
    WHERE action = 'UPDATE' AND log_time >= DATE '2022-02-18' AND user_id IN (SELECT staff_id FROM users)),
changes AS ({_CHANGES}),
joined AS (
    SELECT du.*, se.* EXCLUDE (student_id, fleid), s.custom_196, s.custom_2012197376, ese.code AS packed, program, started,
        {_code("s.custom_821")} AS c_district, {_code("s.custom_822")} AS c_zoned, {_code("s.custom_626")} AS c_ell, {_code("s.custom_71")} AS c_lunch,
        {_code("s.custom_200000244")} AS req, concat(substr({_code("s.custom_1429", "label")}, 3, 2), substr({_code("s.custom_1429", "label")}, 7, 2)) AS ninth
    FROM student_data_updates_temp du LEFT JOIN students s ON s.custom_200000224 = du.fleid LEFT JOIN enrolled se ON se.fleid = du.fleid
    LEFT JOIN ese ON ese.fleid = du.fleid LEFT JOIN dop ON dop.fleid = du.fleid),
compared AS (
    SELECT {_PLAIN_FILE.replace("du.", "")}, lpad(school_of_enrollment, 4, '0') AS padded_school,
        lpad(zoned_district, 2, '0') AS doe_zoned_district, coalesce(c_district, '00') AS focus_zoned_district,
        {_differs("zoned_district_change", "doe_zoned_district", "focus_zoned_district")},
        lpad(zoned_school, 4, '0') AS doe_zoned_school, coalesce(c_zoned, '0000') AS focus_zoned_school,
        {_differs("zoned_school_change", "doe_zoned_school", "focus_zoned_school")},
        lpad(grade_level, 2, '0') AS doe_grade_level, lpad(grade, 2, '0') AS focus_grade_level,
        {_differs("grade_level_change", "doe_grade_level", "focus_grade_level")},
        nullif(ese_code, '0')[1:1] AS doe_primary_ese_code, nullif(packed[1:1], 'Z') AS focus_primary_ese_code,
        {_differs("primary_ese_code_change", "replace(ese_code, '0', 'Z')[1:1]", "packed[1:1]")},
        nullif(ese_code, '0')[2:] AS doe_other_ese_code, CASE WHEN packed[1:1] <> 'Z' THEN packed[2:] END AS focus_other_ese_code,
        {_differs("other_ese_code_change", "doe_other_ese_code", "focus_other_ese_code")},
        ell_code AS doe_ell_code, c_ell AS focus_ell_code, {_differs("ell_code_change", "doe_ell_code", "focus_ell_code")},
        lunch_status AS doe_lunch_status, c_lunch AS focus_lunch_status, {_differs("lunch_status_change", "doe_lunch_status", "focus_lunch_status")},
        CASE WHEN lunch_status_change = 'Y' THEN custom_2012197376 END AS lunch_status_change_date,
        met_grade_10_ela_reading_requirement AS doe_ela_met, {_MET.replace("se.", "")} AS focus_ela_met, {_differs("ela_met_change", "doe_ela_met", "focus_ela_met")},
        CASE WHEN ela_met_change = 'Y' THEN concat(custom_196[3:], custom_196[:2], '01') END AS ela_met_change_date,
        dropout_prevention_juvenile_justice_program_code AS doe_dop_code, program AS focus_dop_code, {_differs("dop_code_change", "doe_dop_code", "focus_dop_code")},
        CASE WHEN dop_code_change = 'Y' THEN started END AS dop_code_change_date,
        withdrawn AS doe_withdrawn, withdrawn_from AS doe_withdrawn_from, nullif(withdrawal_date, '0') AS doe_withdrawal_date,
        CASE WHEN end_date IS NULL THEN 'N' ELSE 'Y' END AS focus_withdrawn,
        {_differs("school_change", "padded_school", "school_num")}, CASE WHEN school_change = 'Y' THEN school END AS school_current,
        CASE WHEN school_change = 'Y' THEN start_date::VARCHAR END AS school_current_start_date,
        {_differs("withdrawn_change", "doe_withdrawn", "focus_withdrawn")}, CASE WHEN withdrawn_change = 'Y' THEN drop_title END AS withdrawn_change_code,
        CASE WHEN withdrawn_change = 'Y' THEN 'NEED TYPE' END AS withdrawn_change_from,
        CASE WHEN withdrawn_change = 'Y' THEN end_date::VARCHAR END AS withdrawn_change_date,
        nullif(year_entered_ninth_grade, '0') AS doe_ye9, ninth AS focus_ye9,
        CASE WHEN year_entered_ninth_grade <> ninth AND focus_grade_level IN ('09', '10', '11', '12') THEN 'Y' END AS ye9_change
    FROM joined)
SELECT DISTINCT compared.* EXCLUDE (padded_school), padded_school AS school_of_enrollment,
    nullif(greatest(zoned_district_change, zoned_school_change, grade_level_change, primary_ese_code_change, other_ese_code_change, ell_code_change,
        lunch_status_change, ela_met_change, dop_code_change, withdrawn_change, school_change, ye9_change), '') AS has_change,
    {", ".join(f"{i}_log.day AS {i}_change_date" for i in _DATED if i != "other_ese_code")},
    CASE WHEN other_ese_code_change = 'Y' THEN other_ese_code_log.day END AS other_ese_code_change_date
FROM compared {" ".join(_dated(i) for i in _DATED if i != "other_ese_code")}
LEFT JOIN changes other_ese_code_log ON other_ese_code_log.fleid = compared.fleid AND other_ese_code_log.item = 'other_ese_code'
    AND compared.primary_ese_code_change = 'Y'
"""


@query("reconciliation", RECONCILIATION_SQL)
def _reconciliation(spark: SparkSession, folder: str) -> DataFrame:
    return reconciliation(model(spark, folder))


# The date of an other-code change without the primary code's having changed.
@query("reconciliation_corrected", RECONCILIATION_SQL.replace("    AND compared.primary_ese_code_change = 'Y'\n", ""))
def _reconciliation_corrected(spark: SparkSession, folder: str) -> DataFrame:
    return reconciliation(model(spark, folder), ReconciliationRun(faithful=False))


# ---------------------------------------------------------------- tickets

_TICKETS = f"WITH {model_sql('tickets')}, weeks AS (SELECT *, (date_trunc('week', day)::DATE - DATE '2024-01-29') // 7 AS week_offset FROM tickets)"


# The same facts in related tables, with a calendar whose weeks begin on Wednesdays and that lacks every eleventh day.
_RELATED = f"""WITH {model_sql('tickets')}, kinds AS (SELECT ticket_idx, channel FROM tickets),
    calls AS (SELECT ticket_idx, call_type FROM tickets WHERE channel = 'Voice' UNION ALL SELECT -1, 'Answered'),
    days AS (SELECT DISTINCT day, CAST(floor((day - DATE '2024-01-31') / 7.0) AS INT) AS week_offset FROM tickets WHERE dayofmonth(day) % 11 <> 0),
    weeks AS (SELECT t.* EXCLUDE (channel, call_type), kinds.channel, calls.call_type, days.week_offset
        FROM tickets t LEFT JOIN kinds USING (ticket_idx) LEFT JOIN calls USING (ticket_idx) LEFT JOIN days USING (day))"""


def _mean(value: str, offset: int) -> str:
    return f"""(sum({value}) FILTER (WHERE week_offset = {offset}))::DOUBLE / count({value}) FILTER (WHERE week_offset = {offset})"""


def _change_sql(group: str, tables: str = _TICKETS) -> str:
    shown = f"{group}, " if group else ""
    return f"""{tables}, means AS (SELECT {shown}coalesce({_mean("resolution", -1)}, 0) AS p, coalesce({_mean("resolution", -2)}, 0) AS q
        FROM weeks {"GROUP BY " + group if group else ""}),
    worded AS (SELECT *, CASE WHEN p > q THEN 'declined' ELSE 'improved' END AS word,
        CASE WHEN q <> 0 THEN regexp_replace(printf('%.2f', round(abs((p - q) / abs(q) * 100), 2)), '\\.?0+$', '') END AS pct FROM means)
    SELECT {shown}CASE WHEN p = 0 OR q = 0 THEN 'No comparison can be done due to one of the past two weeks having no data.'
        WHEN p = q THEN '[DATA UNABLE TO BE PULLED]'
        ELSE 'Your time to resolution last week ' || word || ' <b><span style=''color:#333333''>' || pct || '%</span></b> compared to the prior week.' END AS message
    FROM worded"""


@query("efficiency_change", _change_sql(""))
def _efficiency_change(spark: SparkSession, folder: str) -> DataFrame:
    return week_over_week(model(spark, folder)["tickets"], "day", "resolution", REPORT_WEEK)


@query("efficiency_change_by_customer", _change_sql("id1"))
def _efficiency_change_by_customer(spark: SparkSession, folder: str) -> DataFrame:
    return week_over_week(model(spark, folder)["tickets"], "day", "resolution", REPORT_WEEK, by=["id1"])


def _duration_sql(group: str, tables: str = _TICKETS) -> str:
    shown = f"{group}, " if group else ""
    return f"""{tables}, means AS (SELECT {shown}{_mean("seconds", -1)} AS m, count(ticket_idx) FILTER (WHERE week_offset = -1) AS own,
        count(app_value) FILTER (WHERE week_offset = -1) AS other FROM weeks {"GROUP BY " + group if group else ""}),
    parts AS (SELECT *, m / 3600 AS h, trunc(h) AS hh, (h - hh) * 60 AS mi, trunc(mi) AS mm, round((mi - mm) * 60)::BIGINT AS ss,
        trunc(hh / 24) AS dd, round((hh / 24 - dd) * 24)::BIGINT AS hd FROM means)
    SELECT {shown}CASE WHEN own = 0 OR other = 0 THEN 'N/A' WHEN coalesce(m, 0) = 0 THEN 'Immediate'
        ELSE CASE WHEN hh >= 24 THEN dd::BIGINT || 'd ' || hd || 'h ' WHEN hh >= 1 THEN hh::BIGINT || 'h ' ELSE '' END
            || CASE WHEN hh >= 1 OR mm >= 1 THEN mm::BIGINT || 'm ' ELSE '' END || ss || 's' END AS resolution_time FROM parts"""


def _durations(spark: SparkSession, folder: str, by: list[str] | None) -> DataFrame:
    tickets = model(spark, folder)["tickets"]
    counted = tickets.select("id1", "day", F.col("app_value").alias("ticket_idx"))
    return mean_duration(tickets, "day", "seconds", "ticket_idx", REPORT_WEEK, counted, by)


@query("resolution_time", _duration_sql(""))
def _resolution_time(spark: SparkSession, folder: str) -> DataFrame:
    return _durations(spark, folder, None)


@query("resolution_time_by_customer", _duration_sql("id1"))
def _resolution_time_by_customer(spark: SparkSession, folder: str) -> DataFrame:
    return _durations(spark, folder, ["id1"])


def _channels_sql(tables: str) -> str:
    return f"""{tables}, counted AS (SELECT id1, id2,
        count(app_value) FILTER (WHERE week_offset = -1 AND channel IN ('Online', 'Application')) AS "App",
        count(value) FILTER (WHERE week_offset = -1 AND channel = 'Text') AS "Text Message",
        count(value) FILTER (WHERE week_offset = -1 AND channel = 'Electronic Mail') AS "Email",
        count(value) FILTER (WHERE week_offset = -1 AND channel = 'Voice' AND call_type NOT IN ('Outbound', 'Abandoned')) AS "Incoming Calls",
        count(value) FILTER (WHERE week_offset = -1 AND channel = 'Voice' AND call_type = 'Outbound') AS "Outgoing Calls"
        FROM weeks GROUP BY ALL)
    SELECT *, "App" + "Text Message" + "Email" + "Incoming Calls" + "Outgoing Calls" AS "All", repeat(id2, 2) AS "Connector" FROM counted"""


@query("ticket_channels", _channels_sql(_TICKETS))
def _ticket_channels(spark: SparkSession, folder: str) -> DataFrame:
    return channel_counts(model(spark, folder)["tickets"], "id1", "id2", "day", REPORT_WEEK, "app_value", "value", "channel", "call_type")


def _context_sql(*ids: str) -> str:
    held = [f"{i if i in ids else 'CAST(NULL AS VARCHAR)'} AS {i}" for i in ("id1", "id2")]
    channels = {
        "App": "count(app_value) FILTER (WHERE week_offset = -1 AND channel IN ('Online', 'Application'))",
        "Text Message": "count(value) FILTER (WHERE week_offset = -1 AND channel = 'Text')",
        "Email": "count(value) FILTER (WHERE week_offset = -1 AND channel = 'Electronic Mail')",
        "Incoming Calls": "count(value) FILTER (WHERE week_offset = -1 AND channel = 'Voice' AND call_type NOT IN ('Outbound', 'Abandoned'))",
        "Outgoing Calls": "count(value) FILTER (WHERE week_offset = -1 AND channel = 'Voice' AND call_type = 'Outbound')",
    }
    counted = ", ".join(f'{sql} AS "{name}"' for name, sql in channels.items())
    return f"""(SELECT '{"+".join(ids) or "total"}' AS context, {", ".join(held)}, message, resolution_time,
            "App" + "Text Message" + "Email" + "Incoming Calls" + "Outgoing Calls" AS "All", {", ".join(f'"{n}"' for n in channels)}
        FROM ({_change_sql(", ".join(ids))}) a
        {"JOIN" if ids else "CROSS JOIN"} ({_duration_sql(", ".join(ids))}) b {f"USING ({', '.join(ids)})" if ids else ""}
        {"JOIN" if ids else "CROSS JOIN"} ({_TICKETS} SELECT {", ".join([*ids, counted])} FROM weeks {"GROUP BY " + ", ".join(ids) if ids else ""}) c {f"USING ({', '.join(ids)})" if ids else ""})"""


@query("ticket_measures_in_contexts", " UNION ALL ".join(["SELECT * FROM " + _context_sql(), "SELECT * FROM " + _context_sql("id1"), "SELECT * FROM " + _context_sql("id1", "id2")]))
def _ticket_measures_in_contexts(spark: SparkSession, folder: str) -> DataFrame:
    partials = daily_partials(model(spark, folder)["tickets"], ["id1", "id2"], TicketColumns(counted="app_value"))
    return measures_in_contexts(partials, [[], ["id1"], ["id1", "id2"]], REPORT_WEEK)


def _related(spark: SparkSession, folder: str) -> tuple[DataFrame, GivenWeeks]:
    tickets = model(spark, folder)["tickets"]
    voice = tickets.filter("channel = 'Voice'").select("ticket_idx", "call_type")
    calls = voice.union(spark.sql("SELECT CAST(-1 AS BIGINT) AS ticket_idx, 'Answered' AS call_type"))
    days = tickets.select("day").distinct().filter(F.dayofmonth("day") % 11 != 0)
    offset = F.floor(F.datediff("day", F.lit(dt.date(2024, 1, 31))) / 7).cast("int")
    facts = related(tickets.drop("channel", "call_type"), {"ticket_idx": tickets.select("ticket_idx", "channel")})
    return related(facts, {"ticket_idx": calls}), GivenWeeks(days.select(F.col("day").alias("date"), offset.alias("week_offset")))


@query("efficiency_change_related", _change_sql("", _RELATED))
def _efficiency_change_related(spark: SparkSession, folder: str) -> DataFrame:
    facts, weeks = _related(spark, folder)
    return week_over_week(facts, "day", "resolution", weeks)


@query("resolution_time_related", _duration_sql("id1", _RELATED))
def _resolution_time_related(spark: SparkSession, folder: str) -> DataFrame:
    facts, weeks = _related(spark, folder)
    return mean_duration(facts, "day", "seconds", "ticket_idx", weeks, facts.select("id1", "day", F.col("app_value").alias("ticket_idx")), ["id1"])


@query("ticket_channels_related", _channels_sql(_RELATED))
def _ticket_channels_related(spark: SparkSession, folder: str) -> DataFrame:
    facts, weeks = _related(spark, folder)
    return channel_counts(facts, "id1", "id2", "day", weeks, "app_value", "value", "channel", "call_type")


# ---------------------------------------------------------------- rejected upload values

_UPLOADS = {"benchmark_ia1_to_ia4_temp": ["ia1_p1", "ia4_p1"], "iready_math_upload_temp": ["fall_ss", "spring_ss"]}


def _rejects_sql() -> str:
    values = [
        f"SELECT '{name}' AS upload, '{column}' AS \"column\", {column}::VARCHAR AS value FROM {name}"
        for name, numbers in _UPLOADS.items()
        for column in ["student_id", *numbers]
    ]
    return f"""WITH {model_sql(*_UPLOADS)}, shown AS ({" UNION ALL ".join(values)})
        SELECT upload, "column", value, count(*) AS rows FROM shown
        WHERE value IS NOT NULL AND NOT regexp_full_match(value, '-?[0-9]+') GROUP BY ALL"""


@query("upload_rejects", _rejects_sql())
def _upload_rejects(spark: SparkSession, folder: str) -> DataFrame:
    sis = model(spark, folder)
    return rejects({name: (sis[name], ["student_id"], numbers) for name, numbers in _UPLOADS.items()})
