"""A student-information model and a ticket model derived from the given tables.

Each statement reads whole given tables, so the derived tables grow with them. The statements use
SQL that Spark and the checking engine both understand; ``{name}`` stands for a given table.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from recordkit.queries.tables import read_given

GIVEN = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")

BASE_ID = 4300200420


def _answer_columns() -> str:
    return ", ".join(
        f"CASE WHEN c_custkey % {i + 3} = 0 THEN NULL ELSE CAST((c_custkey + {i}) % 2 AS STRING) END AS _{i}" for i in range(1, 26)
    )


MODEL = {
    "students": f"""
        SELECT {BASE_ID} + c_custkey AS student_id,
               'O' || chr(39) || 'BRIEN-' || c_mktsegment AS last_name,
               CASE WHEN c_custkey % 50 = 0 THEN NULL ELSE lower(c_mktsegment) || ' j.' END AS first_name,
               1 + c_custkey % 2 AS custom_200000000,
               CASE WHEN c_custkey % 31 = 0 THEN NULL ELSE 11 + c_custkey % 4 END AS custom_200000001,
               21 + c_custkey % 6 AS custom_626,
               CASE c_custkey % 4 WHEN 0 THEN NULL WHEN 1 THEN 'L - Gifted' ELSE 'K - Learning' END AS custom_2012197500,
               CASE WHEN c_custkey % 6 = 0 THEN NULL ELSE 31 + c_custkey % 3 END AS custom_821,
               CASE WHEN c_custkey % 8 = 0 THEN NULL ELSE 41 + c_custkey % 4 END AS custom_822,
               51 + c_custkey % 3 AS custom_71,
               61 + c_custkey % 6 AS custom_200000244,
               CASE WHEN c_custkey % 9 = 0 THEN NULL ELSE 71 + c_custkey % 3 END AS custom_1429,
               lpad(CAST(1 + c_custkey % 12 AS STRING), 2, '0') || '2022' AS custom_196,
               '202203' || lpad(CAST(1 + c_custkey % 28 AS STRING), 2, '0') AS custom_2012197376,
               CASE WHEN c_custkey % 89 = 0 THEN NULL
                    WHEN c_custkey % 97 = 1 THEN 'FL' || lpad(CAST(c_custkey - 1 AS STRING), 12, '0')
                    ELSE 'FL' || lpad(CAST(c_custkey AS STRING), 12, '0') END AS custom_200000224
        FROM {{customer}}""",
    "custom_field_select_options": """
        SELECT CAST(id AS BIGINT) AS id, code, label FROM (VALUES
            (1, 'F', 'F - Female'), (2, 'M', 'M - Male'),
            (11, 'W', 'White, Non-Hispanic'), (12, 'B', 'Black, Non-Hispanic'), (13, 'H', 'Hispanic'), (14, 'O', 'Other-Multiracial'),
            (21, 'LA', 'LA - Adapting'), (22, 'LF', 'LF - Former'), (23, 'LY', 'LY - Learner'), (24, 'LZ', 'LZ - Past'), (25, 'ZZ', 'ZZ - None'),
            (31, '43', 'Here'), (32, '50', 'Next'), (33, '00', 'None'),
            (41, '0051', 'A'), (42, '0101', 'B'), (43, '0291', 'C'), (44, '0011', 'D'),
            (51, '0', 'Paid'), (52, '2', 'Reduced'), (53, '3', 'Free'),
            (61, 'Y', 'Yes'), (62, 'YC', 'Yes, concordant'), (63, 'YW', 'Yes, waived'), (64, 'N', 'No'), (65, 'Z', 'Not asked'),
            (71, 'A', '20182019'), (72, 'B', '20192020'), (73, 'C', '20202021'),
            (81, 'K', 'K'), (82, 'F', 'F'), (83, 'G', 'G'), (84, 'V', 'V'), (85, 'W', 'W'),
            (91, 'A', 'Active'), (92, 'I', 'Inactive'),
            (101, 'A', 'Attendance'), (102, 'D', 'Academic'), (103, 'E', 'Other')) AS t(id, code, label)""",
    "student_enrollment": f"""
        SELECT {BASE_ID} + o_custkey AS student_id,
               (o_custkey * 7 + o_orderkey % 3) % 25 AS school_id,
               1 + o_custkey % 12 AS grade_id,
               CASE WHEN o_orderkey % 5 = 0 THEN 2020 ELSE 2021 END AS syear,
               DATE '2021-08-11' + CAST(o_orderkey % 260 AS INT) AS start_date,
               CASE o_orderstatus WHEN 'O' THEN NULL
                    WHEN 'P' THEN DATE '2022-05-25' + CAST(o_orderkey % 12 AS INT)
                    ELSE DATE '2021-08-11' + CAST(o_orderkey % 260 + 1 + o_orderkey % 90 AS INT) END AS end_date,
               CASE o_orderkey % 10 WHEN 0 THEN 'Y' WHEN 1 THEN NULL ELSE 'N' END AS custom_9,
               CASE WHEN o_orderstatus = 'O' THEN NULL ELSE 1 + o_orderkey % 6 END AS drop_code
        FROM {{orders}}""",
    "student_enrollment_codes": """
        SELECT CAST(r_regionkey + 1 AS BIGINT) AS id, 'W0' || CAST(r_regionkey AS STRING) AS title FROM {region}""",
    "schools": """
        SELECT CAST(n_nationkey AS BIGINT) AS id, n_name AS title,
               CASE WHEN n_nationkey = 20 THEN '0291' ELSE lpad(CAST(n_nationkey * 10 + 1 AS STRING), 4, '0') END AS custom_327
        FROM {nation}""",
    "school_gradelevels": """
        SELECT CAST(n_nationkey AS BIGINT) AS id, lpad(CAST(n_nationkey AS STRING), 2, '0') AS title FROM {nation}""",
    "marking_periods": " UNION ALL ".join(
        f"""SELECT CAST(n_nationkey * 10 + {i} AS BIGINT) AS marking_period_id, CAST(n_nationkey AS BIGINT) AS school_id, {year} AS syear,
                   '{short}' AS short_name, '{title}' AS title, DATE '{end}' AS end_date FROM {{nation}}"""
        for i, year, short, title, end in (
            (1, 2021, "FY", "Full Year", "2022-05-31"),
            (2, 2020, "FY", "Full Year", "2021-06-01"),
            (3, 2021, "S1", "Semester 1", "2021-12-17"),
            (4, 2021, "S2", "Semester 2", "2022-05-31"),
        )
    ),
    "attendance_day": f"""
        SELECT {BASE_ID} + l_partkey AS student_id,
               CASE WHEN l_suppkey % 4 = 0 THEN 2020 ELSE 2021 END AS syear,
               CASE WHEN l_linenumber = 7 AND l_linestatus = 'F' THEN NULL
                    WHEN l_returnflag = 'R' AND l_linenumber <= 2 THEN 0 ELSE 1 END AS state_value
        FROM {{lineitem}}""",
    "discipline_referrals": f"""
        SELECT {BASE_ID} + user_id AS student_id, event_id - event_id % 3 AS referral_id, 2021 AS syear FROM {{events}}""",
    "test_history_tests": """
        SELECT CAST(n_nationkey AS BIGINT) AS id,
               CASE n_nationkey % 7 WHEN 0 THEN 'FSA ELA ' WHEN 1 THEN 'Fsa Math ' WHEN 2 THEN 'APM Q1 ' WHEN 3 THEN 'APM Summer '
                    WHEN 4 THEN 'APM Q3 ' WHEN 5 THEN 'Retake FSA ELA ' ELSE 'fsa ela ' END || n_name AS title
        FROM {nation}""",
    "test_history_parts": """
        SELECT CAST(n_nationkey * 10 + 1 AS BIGINT) AS id, CAST(n_nationkey AS BIGINT) AS test_id, 'Math Proficiency' AS title FROM {nation}
        UNION ALL
        SELECT CAST(n_nationkey * 10 + 2 AS BIGINT), CAST(n_nationkey AS BIGINT), 'Reading Proficiency' FROM {nation}""",
    "test_history_score_types": """
        SELECT CAST(r_regionkey + 1 AS BIGINT) AS id, CASE WHEN r_regionkey = 0 THEN 'AL' ELSE 'T' || CAST(r_regionkey AS STRING) END AS short_name
        FROM {region}""",
    "test_history_administrations": f"""
        SELECT o_orderkey AS id, {BASE_ID} + o_custkey AS student_id, o_orderkey % 25 AS test_id, CAST(o_orderdate AS DATE) AS administration_date
        FROM {{orders}}""",
    "test_history_scores": """
        SELECT l_orderkey AS administration_id, l_orderkey % 25 AS test_id,
               (l_orderkey % 25) * 10 + 1 + l_linenumber % 2 AS part_id, 1 + l_suppkey % 3 AS score_type_id,
               CAST(1 + l_partkey % 5 AS INT) AS score,
               CASE l_partkey % 7 WHEN 0 THEN 'Inadequate' WHEN 1 THEN 'Below Satisfactory' WHEN 2 THEN 'Satisfactory'
                    WHEN 3 THEN 'Proficient' WHEN 4 THEN 'Mastery' WHEN 5 THEN 'Unscored' ELSE NULL END AS test_code
        FROM {lineitem}""",
    "benchmark_ia1_to_ia4_temp": f"""
        SELECT CAST({BASE_ID} + c_custkey AS STRING) AS student_id,
               CASE c_custkey % 11 WHEN 0 THEN '' WHEN 1 THEN 'absent' ELSE CAST(c_custkey % 37 AS STRING) END AS ia1_p1,
               CAST(c_custkey % 41 AS STRING) AS ia4_p1
        FROM {{customer}}
        UNION ALL
        SELECT CAST({BASE_ID} + s_suppkey AS STRING), '5', CAST(s_suppkey % 9 AS STRING) FROM {{supplier}}""",
    "iready_math_upload_temp": f"""
        SELECT CAST({BASE_ID} + c_custkey AS STRING) AS student_id,
               CAST(400 + c_custkey % 53 AS STRING) AS fall_ss, CAST(c_custkey % 99 AS STRING) AS fall_pr, 'Level ' || CAST(c_custkey % 4 AS STRING) AS fall_rp,
               CASE WHEN c_custkey % 17 = 0 THEN NULL ELSE CAST(400 + c_custkey % 61 AS STRING) END AS spring_ss,
               CAST(c_custkey % 98 AS STRING) AS spring_pr, 'Level ' || CAST(c_custkey % 5 AS STRING) AS spring_rp
        FROM {{customer}}""",
    "report_card_grade_scales": """
        SELECT CAST(n_nationkey AS BIGINT) AS id,
               CASE n_nationkey % 6 WHEN 0 THEN 'Weight 5 AP IB AICE DE' WHEN 1 THEN 'Weight 4.5 Honors & Advanced' WHEN 2 THEN 'Weight 4 On Level'
                    WHEN 3 THEN 'Weight 7 AP DE IB' WHEN 4 THEN 'Weight 6 Honors & Advanced' ELSE 'Pass Fail' END AS title
        FROM {nation}""",
    "student_report_card_grades": f"""
        SELECT {BASE_ID} + l_partkey AS student_id, l_suppkey % 25 AS school_id, CAST(2019 + l_orderkey % 3 AS INT) AS syear,
               CAST((l_suppkey % 25) * 10 + 3 AS STRING) AS marking_period_id, l_linenumber AS report_card_grade_id,
               'Course ' || CAST(l_suppkey % 40 AS STRING) AS course_title,
               CASE WHEN l_suppkey % 9 = 0 THEN '79' ELSE '12' END || CAST(l_suppkey % 40 AS STRING) AS course_num,
               CAST(CASE WHEN l_linenumber = 7 THEN 0 ELSE 1 + l_orderkey % 2 END AS DECIMAL(18,4)) AS credits,
               CAST(CASE WHEN l_returnflag = 'R' THEN 0 ELSE 1 + l_orderkey % 2 END AS DECIMAL(18,4)) AS credits_earned,
               CASE (l_orderkey + l_linenumber) % 11 WHEN 0 THEN 'A' WHEN 1 THEN 'B' WHEN 2 THEN 'C' WHEN 3 THEN 'D' WHEN 4 THEN 'F' WHEN 5 THEN 'A'
                    WHEN 6 THEN 'B' WHEN 7 THEN 'P' WHEN 8 THEN 'WP' WHEN 9 THEN 'I' ELSE 'X' END AS grade_title,
               CAST(CASE (l_orderkey + l_linenumber) % 11 WHEN 0 THEN 4 WHEN 1 THEN 3 WHEN 2 THEN 2 WHEN 3 THEN 1 WHEN 4 THEN 0 WHEN 5 THEN 4
                    WHEN 6 THEN 3 ELSE NULL END AS DECIMAL(18,4)) AS gpa_points,
               CAST((l_orderkey + l_partkey) % 6 AS DECIMAL(18,4)) AS weighted_gpa_points,
               l_suppkey % 25 AS grade_scale_id,
               CASE WHEN l_orderkey % 7 = 0 THEN 'N' ELSE 'Y' END AS course_history,
               CASE WHEN l_partkey % 13 = 0 THEN 'N' ELSE 'Y' END AS affects_gpa,
               lpad(CAST(9 + l_partkey % 4 AS STRING), 2, '0') AS gradelevel_title,
               lpad(CAST(9 + l_partkey % 4 AS STRING), 2, '0') AS custom_7,
               CAST(l_shipdate AS DATE) AS updated_at
        FROM {{lineitem}}""",
    "schedule": f"""
        SELECT {BASE_ID} + o_custkey AS student_id, (o_custkey * 7 + o_orderkey % 3) % 25 AS school_id, 2021 AS syear,
               l_suppkey AS course_period_id,
               DATE '2021-08-11' + CAST((o_orderkey + l_linenumber * 17) % 260 AS INT) AS start_date,
               CASE l_returnflag WHEN 'A' THEN NULL WHEN 'N' THEN DATE '2022-03-01' + CAST(l_partkey % 20 AS INT)
                    ELSE DATE '2021-08-11' + CAST((o_orderkey + l_linenumber * 17) % 260 + 30 AS INT) END AS end_date
        FROM {{lineitem}} JOIN {{orders}} ON o_orderkey = l_orderkey""",
    "course_periods": """
        SELECT s_suppkey AS course_period_id, CASE WHEN s_suppkey % 3 = 0 THEN NULL ELSE s_nationkey * 10 + 3 + s_suppkey % 2 END AS marking_period_id,
               s_suppkey % 6 AS period_id, CAST(s_nationkey AS BIGINT) AS course_id, s_suppkey AS teacher_id, 2021 AS syear, s_name AS title
        FROM {supplier}""",
    "school_periods": "SELECT CAST(r_regionkey AS BIGINT) AS period_id FROM {region}",
    "courses": """
        SELECT CAST(n_nationkey AS BIGINT) AS course_id, 2021 AS syear,
               CASE n_nationkey % 5 WHEN 0 THEN 'M/J Civics ' WHEN 1 THEN 'US HISTORY ' ELSE 'Algebra ' END || n_name AS title
        FROM {nation}""",
    "users": "SELECT s_suppkey AS staff_id, 'jo-ann' AS first_name, s_name AS last_name FROM {supplier}",
    "pm_civics_flip_temp": f"""
        SELECT CAST({BASE_ID} + c_custkey AS STRING) AS student_id,
               CASE WHEN c_custkey % 29 = 0 THEN NULL ELSE CAST(c_custkey % 101 AS STRING) END AS test_score_, {_answer_columns()}
        FROM {{customer}}""",
    "pm_civics_standards_temp": """
        SELECT CAST(n_nationkey AS STRING) AS question, 'SS.7.' || CAST(n_nationkey AS STRING) AS standard, n_name AS description,
               'Category ' || CAST(n_regionkey AS STRING) AS reporting_category
        FROM {nation}
        UNION ALL
        SELECT CAST(r_regionkey + 3 AS STRING), 'SS.7.X', r_name, 'Second key row' FROM {region}""",
    "database_object_log": f"""
        SELECT {BASE_ID} + user_id AS student_id, event_id % 130 AS user_id,
               CASE event_type WHEN 'view' THEN 'INSERT' ELSE 'UPDATE' END AS action,
               CASE event_id % 9 WHEN 0 THEN 'CUSTOM_821=' WHEN 1 THEN 'CUSTOM_822,CUSTOM_821=' WHEN 2 THEN 'LOG_FIELD4=' WHEN 3 THEN 'LOG_FIELD6='
                    WHEN 4 THEN 'GRADE_ID=' WHEN 5 THEN 'CUSTOM_626=' WHEN 6 THEN 'CUSTOMX821=' WHEN 7 THEN NULL ELSE 'OTHER=' END || props AS after,
               ts - INTERVAL '700' DAY AS log_time
        FROM {{events}}""",
    "custom_field_log_entries": f"""
        SELECT {BASE_ID} + l_partkey AS source_id, CASE WHEN l_linestatus = 'F' THEN 457 ELSE 312 END AS field_id,
               CAST(101 + l_suppkey % 4 AS STRING) AS log_field1,
               CASE WHEN l_returnflag = 'A' THEN 'Y' ELSE 'N' END AS log_field2,
               CASE WHEN l_suppkey % 23 = 0 THEN '082' ELSE CAST(81 + l_suppkey % 6 AS STRING) END AS log_field3,
               CASE WHEN l_linestatus = 'O' THEN CAST(DATE '2022-01-15' + CAST(l_orderkey % 60 AS INT) AS STRING)
                    WHEN l_linenumber = 1 THEN 'Y' WHEN l_linenumber = 2 THEN NULL ELSE 'N' END AS log_field4,
               CASE WHEN l_suppkey % 5 = 0 THEN NULL ELSE '2022-03-01' END AS log_field5,
               CAST(91 + l_orderkey % 2 AS STRING) AS log_field6,
               CASE WHEN l_suppkey % 3 = 0 THEN '2022-01-01' ELSE NULL END AS log_field12
        FROM {{lineitem}}""",
    "student_data_updates_temp": """
        SELECT CAST(c_custkey AS STRING) AS record_id, '43' AS district_of_enrollment,
               CAST((c_custkey * 7 % 25) * 10 + 1 AS STRING) AS school_of_enrollment,
               c_mktsegment AS student_last_name, c_name AS student_first_name,
               CASE WHEN c_custkey % 83 = 0 THEN NULL WHEN c_custkey % 71 = 0 THEN 'unknown'
                    ELSE 'FL' || lpad(CAST(c_custkey AS STRING), 12, '0') END AS fleid,
               '20050101' AS date_of_birth, CASE c_custkey % 2 WHEN 0 THEN 'F' ELSE 'M' END AS sex, 'W' AS race,
               'Y' AS full_year_school, 'Y' AS full_year_district, 'N' AS ext_med,
               CASE c_custkey % 4 WHEN 0 THEN '43' WHEN 1 THEN '0' WHEN 2 THEN '50' ELSE NULL END AS zoned_district,
               CASE c_custkey % 4 WHEN 0 THEN '51' WHEN 1 THEN '101' WHEN 2 THEN '0' ELSE NULL END AS zoned_school,
               CAST(1 + c_custkey % 12 - CASE WHEN c_custkey % 10 = 0 THEN 1 ELSE 0 END AS STRING) AS grade_level,
               CASE c_custkey % 5 WHEN 0 THEN '0' WHEN 1 THEN 'KZZZZZZZZZ' WHEN 2 THEN 'FGGGVVVZZZ' WHEN 3 THEN 'K' ELSE NULL END AS ese_code,
               CASE c_custkey % 5 WHEN 0 THEN 'LA' WHEN 1 THEN 'ZZ' WHEN 2 THEN NULL WHEN 3 THEN 'LZ' ELSE 'LY' END AS ell_code,
               CASE c_custkey % 4 WHEN 0 THEN '0' WHEN 1 THEN '2' WHEN 2 THEN '3' ELSE NULL END AS lunch_status,
               CASE c_custkey % 3 WHEN 0 THEN 'Y' WHEN 1 THEN 'N' ELSE 'Z' END AS met_grade_10_ela_reading_requirement,
               CASE c_custkey % 3 WHEN 0 THEN 'A' WHEN 1 THEN 'Z' ELSE NULL END AS dropout_prevention_juvenile_justice_program_code,
               CASE c_custkey % 3 WHEN 0 THEN 'Y' ELSE 'N' END AS withdrawn,
               CASE c_custkey % 3 WHEN 0 THEN 'S' ELSE NULL END AS withdrawn_from,
               CASE c_custkey % 3 WHEN 0 THEN '20220301' ELSE '0' END AS withdrawal_date,
               CASE c_custkey % 4 WHEN 0 THEN '1819' WHEN 1 THEN '1920' WHEN 2 THEN '0' ELSE NULL END AS year_entered_ninth_grade
        FROM {customer}""",
    "tickets": """
        SELECT event_id AS ticket_idx, CAST(ts AS DATE) AS day, CAST(user_id AS STRING) AS id1, CAST(user_id % 7 AS STRING) AS id2,
               CASE WHEN event_id % 11 = 0 THEN NULL ELSE value END AS value,
               CASE user_id % 10 WHEN 0 THEN NULL WHEN 1 THEN CAST(5 AS DOUBLE)
                    WHEN 2 THEN CASE WHEN CAST(ts AS DATE) < DATE '2024-01-22' THEN value ELSE NULL END ELSE value END AS resolution,
               CAST(value AS DECIMAL(18,2)) * CASE user_id % 10 WHEN 0 THEN NULL WHEN 1 THEN 1 WHEN 2 THEN 15 WHEN 3 THEN 200 WHEN 4 THEN 9000
                    WHEN 5 THEN 0 ELSE 900 END AS seconds,
               CASE WHEN event_id % 13 = 0 THEN NULL ELSE event_id END AS app_value,
               CASE event_type WHEN 'signup' THEN 'Online' WHEN 'click' THEN 'Text' WHEN 'purchase' THEN 'Electronic Mail' WHEN 'view' THEN 'Voice'
                    ELSE CASE event_id % 2 WHEN 0 THEN 'Application' ELSE 'Fax' END END AS channel,
               CASE event_id % 5 WHEN 0 THEN 'Answered' WHEN 1 THEN 'Missed' WHEN 2 THEN 'Voicemail Response' WHEN 3 THEN 'Outbound'
                    ELSE 'Abandoned' END AS call_type
        FROM {events}""",
}


class Model(Mapping):
    """The derived tables as DataFrames over the given tables, each built on first use."""

    def __init__(self, spark: SparkSession, folder: str):
        self._spark, self._folder, self._built = spark, folder, {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            text = MODEL[name]
            given = {g: read_given(self._spark, self._folder, g) for g in GIVEN if "{" + g + "}" in text}
            self._built[name] = self._spark.sql(text, **given)
        return self._built[name]

    def __iter__(self):
        return iter(MODEL)

    def __len__(self) -> int:
        return len(MODEL)


def model(spark: SparkSession, folder: str) -> Model:
    return Model(spark, folder)


def model_sql(*names: str) -> str:
    """The named derived tables as leading WITH entries (without the keyword)."""
    plain = {name: name for name in GIVEN}
    return ",\n".join(f"{name} AS ({MODEL[name].format(**plain)})" for name in names)
