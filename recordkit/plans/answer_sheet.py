"""Wide assessment sheet to one row per student, course and question, with the answer key."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, functions as F

from recordkit.functions.rules import uploaded_id
from recordkit.functions.text import full_name, pad_zeros
from recordkit.operators.keys import first_rows_of_join
from recordkit.operators.reshape import unpivot_scores
from recordkit.operators.windows import AssessmentWindow, course_member, school_member


@dataclass(frozen=True)
class SheetRun:
    """Fixed values of one assessment."""

    syear: int = 2021
    labels: dict[str, str] = field(
        default_factory=lambda: {
            "subject": "Social Studies",
            "subject_category": "Civics",
            "test_name": "Civics CQA3",
            "test_date": "20220311",
            "time_period": "Quarter 3",
        }
    )
    school_year: str = "2022"
    window: AssessmentWindow = AssessmentWindow(dt.date(2021, 8, 11), dt.date(2022, 3, 7), dt.date(2022, 3, 11))
    course_likes: tuple[str, ...] = ("%CIV%", "%HIST%")
    semester: str = "S1"
    overall: str = "test_score_"
    questions: tuple[str, ...] = tuple(f"_{i}" for i in range(1, 26))


KEY_COLUMNS = ["standard", "description", "reporting_category"]


def qualifying_courses(sis: Mapping[str, DataFrame], run: SheetRun) -> DataFrame:
    """Course periods of matching courses that run all year or in the wanted semester."""
    title = F.col("course")
    matches = title.ilike(run.course_likes[0])
    for pattern in run.course_likes[1:]:
        matches = matches | title.ilike(pattern)
    courses = sis["courses"].filter(F.col("syear") == run.syear).select("course_id", F.col("title").alias("course")).filter(matches)
    terms = sis["marking_periods"].select("marking_period_id", F.col("short_name").alias("_term"))
    teachers = sis["users"].select(F.col("staff_id").alias("teacher_id"), full_name("last_name", "first_name").alias("teacher"))
    return (
        sis["course_periods"]
        .filter(F.col("syear") == run.syear)
        .select("course_period_id", "marking_period_id", "period_id", "course_id", "teacher_id")
        .join(courses, "course_id")
        .join(terms, "marking_period_id", "left")
        .filter(F.col("_term").isNull() | (F.col("_term") == run.semester))
        .join(sis["school_periods"].select("period_id"), "period_id")
        .join(teachers, "teacher_id")
        .select("course_period_id", "course", "teacher")
    )


def scheduled_rows(sis: Mapping[str, DataFrame], run: SheetRun) -> DataFrame:
    """Schedule rows of qualifying courses that began by the first day of the window."""
    scheduled = (
        sis["schedule"]
        .filter((F.col("syear") == run.syear) & (F.col("start_date") <= F.lit(run.window.opens).cast("date")))
        .select("student_id", "school_id", "course_period_id", F.col("start_date").alias("sch_start"), F.col("end_date").alias("sch_end"))
    )
    return scheduled.join(qualifying_courses(sis, run), "course_period_id")


def enrolment_rows(sis: Mapping[str, DataFrame], run: SheetRun) -> DataFrame:
    """First enrolments of the year with their school and grade."""
    enrolled = (
        sis["student_enrollment"]
        .filter((F.col("syear") == run.syear) & (F.coalesce("custom_9", F.lit("N")) == "N"))
        .select("student_id", "school_id", "grade_id", F.col("start_date").alias("se_start"), F.col("end_date").alias("se_end"))
    )
    school = sis["schools"].select(F.col("id").alias("school_id"), F.col("custom_327").alias("school_code"), F.col("title").alias("school_name"))
    grade = sis["school_gradelevels"].select(F.col("id").alias("grade_id"), F.col("title").alias("grade"))
    return enrolled.join(school, "school_id").join(grade, "grade_id").drop("grade_id")


CANDIDATE = ["school_code", "school_name", "grade", "course", "teacher", "course_period_id", "se_start", "se_end", "sch_start", "sch_end"]


def assessed_students(sis: Mapping[str, DataFrame], run: SheetRun) -> DataFrame:
    """Uploaded students with the school and course they were in during the window; one row per
    qualifying enrolment and course, and per copy in the upload.

    Every enrolment of a student meets every schedule row in the same school, but this product is not made. A pair
    qualifies by its two rows alone, in which case rows that do not are left out before they meet, or because it is the
    newest of the student in some order, and those few pairs are found from the newest rows of each side.
    """
    w, on = run.window, ["student_id", "school_id"]
    uploaded = sis["pm_civics_flip_temp"].select(uploaded_id(F.col("student_id")).alias("student_id")).filter("student_id IS NOT NULL")
    scheduled = scheduled_rows(sis, run).join(uploaded, "student_id", "left_semi")
    enrolled = enrolment_rows(sis, run).join(uploaded, "student_id", "left_semi")
    no = F.lit(False)
    in_course = course_member(w, F.col("sch_start"), F.col("sch_end"), no)
    in_school = school_member(w, F.col("se_start"), F.col("se_end"), no, no)
    plain = scheduled.filter(in_course).join(enrolled.filter(in_school), on).join(uploaded, "student_id")
    newest = {"_sch_end": "sch_end", "_se_start": "se_start", "_se_end": "se_end"}
    marked = first_rows_of_join(scheduled, enrolled, on, ["student_id"], newest, CANDIDATE)
    by_course = course_member(w, F.col("sch_start"), F.col("sch_end"), F.col("_sch_end"))
    by_school = school_member(w, F.col("se_start"), F.col("se_end"), F.col("_se_start"), F.col("_se_end"))
    # Only one copy of a pair is the newest; a pair that qualifies by its rows is there with all its copies.
    special = marked.filter(by_course & by_school & ~F.coalesce(in_course & in_school, no))
    rows = plain.select("student_id", *CANDIDATE).unionByName(special.select("student_id", *CANDIDATE))
    people = sis["students"].select("student_id", "last_name", "first_name")
    return rows.join(people, "student_id").select(
        F.lit(run.school_year).alias("school_year"),
        "student_id",
        F.col("last_name").alias("student_last"),
        F.col("first_name").alias("student_first"),
        full_name("last_name", "first_name").alias("student_full"),
        pad_zeros("school_code", 4).alias("school_id"),
        "school_name",
        "course",
        "teacher",
        F.col("grade").alias("assessment_grade_level"),
        *[F.lit(value).alias(name) for name, value in run.labels.items()],
        F.col("se_start").alias("enrollment_start"),
    )


def answer_rows(sis: Mapping[str, DataFrame], run: SheetRun = SheetRun(), ordered: bool = True) -> DataFrame:
    """One row per assessed student, question and key row, ordered by student.

    The order also names course, school and enrolment, so that one student's rows can be spread over ranges.
    """
    general = assessed_students(sis, run)
    sheet = sis["pm_civics_flip_temp"]
    sheet = sheet.select(uploaded_id(F.col("student_id")).alias("student_id"), run.overall, *run.questions)
    wide = general.join(sheet, "student_id").withColumn("student_id", F.col("student_id").cast("string"))
    order = ["student_id", "course", "school_id", "enrollment_start", "teacher"] if ordered else None
    return unpivot_scores(wide, general.columns, run.overall, list(run.questions), sis["pm_civics_standards_temp"], KEY_COLUMNS, order)
