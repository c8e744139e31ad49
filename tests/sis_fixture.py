"""Invented student-information tables for report tests."""

from __future__ import annotations

SCHEMAS = {
    "students": "student_id long, last_name string, first_name string, custom_200000000 long, custom_200000001 long, custom_626 long, custom_2012197500 string, custom_821 long, custom_822 long, custom_71 long, custom_200000244 long, custom_1429 long, custom_196 string, custom_2012197376 string, custom_200000224 string",
    "student_enrollment": "student_id long, school_id long, grade_id long, syear int, start_date date, end_date date, custom_9 string, drop_code long",
    "student_enrollment_codes": "id long, title string",
    "schools": "id long, title string, custom_327 string",
    "school_gradelevels": "id long, title string",
    "marking_periods": "marking_period_id long, school_id long, syear int, short_name string, title string, end_date date",
    "custom_field_select_options": "id long, code string, label string",
    "custom_field_log_entries": "source_id long, field_id long, log_field1 string, log_field2 string, log_field3 string, log_field4 string, log_field5 string, log_field6 string, log_field12 string",
    "database_object_log": "student_id long, user_id long, action string, after string, log_time timestamp",
    "users": "staff_id long, first_name string, last_name string",
    "attendance_day": "student_id long, syear int, state_value int",
    "discipline_referrals": "student_id long, referral_id long, syear int",
    "test_history_administrations": "id long, student_id long, test_id long, administration_date date",
    "test_history_tests": "id long, title string",
    "test_history_parts": "id long, test_id long, title string",
    "test_history_scores": "administration_id long, test_id long, part_id long, score_type_id long, score int, test_code string",
    "test_history_score_types": "id long, short_name string",
    "student_report_card_grades": "student_id long, school_id long, syear int, marking_period_id string, report_card_grade_id long, course_title string, course_num string, credits decimal(18,4), credits_earned decimal(18,4), grade_title string, gpa_points decimal(18,4), weighted_gpa_points decimal(18,4), grade_scale_id long, course_history string, affects_gpa string, gradelevel_title string, custom_7 string, updated_at timestamp",
    "report_card_grade_scales": "id long, title string",
    "schedule": "student_id long, school_id long, syear int, course_period_id long, start_date date, end_date date",
    "course_periods": "course_period_id long, marking_period_id long, period_id long, course_id long, teacher_id long, syear int, title string",
    "school_periods": "period_id long",
    "courses": "course_id long, syear int, title string",
    "benchmark_ia1_to_ia4_temp": "student_id string, ia1_p1 string, ia4_p1 string",
    "iready_math_upload_temp": "student_id string, fall_ss string, fall_pr string, fall_rp string, spring_ss string, spring_pr string, spring_rp string",
    "student_data_updates_temp": "record_id string, district_of_enrollment string, school_of_enrollment string, student_last_name string, student_first_name string, fleid string, date_of_birth string, sex string, race string, full_year_school string, full_year_district string, ext_med string, zoned_district string, zoned_school string, grade_level string, ese_code string, ell_code string, lunch_status string, met_grade_10_ela_reading_requirement string, dropout_prevention_juvenile_justice_program_code string, withdrawn string, withdrawn_from string, withdrawal_date string, year_entered_ninth_grade string",
    "pm_civics_flip_temp": "student_id string, test_score_ string, " + ", ".join(f"_{i} string" for i in range(1, 26)),
    "pm_civics_standards_temp": "question string, standard string, description string, reporting_category string",
}


def columns(table: str) -> list[str]:
    return [part.split()[0] for part in SCHEMAS[table].replace("decimal(18,4)", "decimal").split(", ")]


def sis(spark, **tables: list[dict]):
    """Every table as a frame: the given rows (missing columns NULL), else empty."""
    out = {}
    for name, schema in SCHEMAS.items():
        given = tables.get(name, [])
        unknown = {k for row in given for k in row} - set(columns(name))
        assert not unknown, unknown
        out[name] = spark.createDataFrame([tuple(row.get(c) for c in columns(name)) for row in given], schema)
    assert set(tables) <= set(SCHEMAS)
    return out
