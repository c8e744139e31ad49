"""GPA, class rank and percentile under two scales, side by side."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from recordkit.functions.rules import percent
from recordkit.operators.grades import credit_totals, enrolled_at_period_end, first_rule, gpa, quality_points, scale_points
from recordkit.operators.ranking import rank_in_group
from recordkit.sources.params import optional_equals, value_or_all
from recordkit.sources.tables import stage

# The old scale of titles used since the change, the points of an A per scale, the
# letters that earn no points, and the high-school grades.
OLD_SCALE = {"Weight 5 AP IB AICE DE": "7", "Weight 4.5 Honors & Advanced": "6", "Weight 4 On Level": "5"}
SCALES = {"7": 7, "6": 6, "5": 5, "4": 4}
ZERO_LETTERS = ("F", "P", "T", "W")
HIGH_SCHOOL = ("09", "10", "11", "12")


@dataclass(frozen=True)
class AuditRun:
    """Report parameters: the year, one school or all, and one or more grades or ``ALL``."""

    syear: int = 2021
    school_id: int | None = None
    grades: str | tuple[str, ...] = "ALL"
    first_new_year: int = 2021
    full_year: str = "FY"
    end_days: int = 10


def course_points(sis: Mapping[str, DataFrame], run: AuditRun) -> DataFrame:
    """Credit-bearing courses of all years with three kinds of quality points."""
    title = F.col("grade_scale")
    scales = sis["report_card_grade_scales"].select(F.col("id").alias("grade_scale_id"), F.col("title").alias("grade_scale"))
    wanted = (F.col("course_history") == "Y") & (F.col("affects_gpa") == "Y") & (F.col("credits") != 0)
    new_year = F.col("syear") >= run.first_new_year
    current_scale = F.substring(title, 8, 1)
    old_scale = first_rule([(new_year & (title == t), F.lit(s)) for t, s in OLD_SCALE.items()], current_scale)
    courses = sis["student_report_card_grades"].filter(wanted).join(scales, "grade_scale_id").withColumn("old_scale_value", old_scale)
    courses = scale_points(courses, "old_scale_value", "grade_title", "old_points", SCALES, ZERO_LETTERS)

    def earned(points: str) -> Column:
        return quality_points(F.col("credits_earned"), F.col(points))

    return courses.select(
        "student_id",
        "syear",
        "course_title",
        "credits",
        "credits_earned",
        "grade_title",
        "grade_scale",
        "old_scale_value",
        current_scale.alias("current_scale_value"),
        earned("gpa_points").alias("unweighted"),
        earned("old_points").alias("adjusted"),
        earned("weighted_gpa_points").alias("current"),
    )


def enrolled_groups(sis: Mapping[str, DataFrame], run: AuditRun) -> DataFrame:
    """Students enrolled at the end of the year per school and grade, with how often."""
    school = sis["schools"].filter(optional_equals(F.col("id"), run.school_id))
    school = school.select(F.col("id").alias("school_id"), F.col("title").alias("school"))
    level = sis["school_gradelevels"].filter(value_or_all(F.col("title"), run.grades, HIGH_SCHOOL))
    level = level.select(F.col("id").alias("grade_id"), F.col("title").alias("grade_level"))
    period = sis["marking_periods"].filter((F.col("short_name") == run.full_year) & (F.col("syear") == run.syear))
    period = period.select("school_id", F.col("end_date").alias("period_end"))
    rows = (
        sis["student_enrollment"]
        .filter(F.col("syear") == run.syear)
        .select("student_id", "school_id", "grade_id", "end_date")
        .join(school, "school_id")
        .join(level, "grade_id")
        .join(period, "school_id")
    )
    rows = enrolled_at_period_end(rows, "end_date", "period_end", run.end_days)
    counted = rows.groupBy("student_id", "school", "grade_level").agg(F.count(F.lit(1)).alias("_times"))
    return counted.join(sis["students"].select("student_id"), "student_id")


def student_gpas(sis: Mapping[str, DataFrame], run: AuditRun) -> DataFrame:
    """Totals and GPAs per student, school and grade.

    Courses are summed per student before they meet the enrolments; with one school, only its students' courses are. A student enrolled n times in
    the same school and grade counts each course n times, which the sums are multiplied by.
    """
    sums = ["credits", "credits_earned", "unweighted", "adjusted", "current"]
    enrolled, courses = enrolled_groups(sis, run), course_points(sis, run)
    if run.school_id is not None:
        enrolled = stage(enrolled, "school-enrolments")
        courses = courses.join(enrolled.select("student_id"), "student_id", "left_semi")
    joined = enrolled.join(credit_totals(courses, ["student_id"], sums), "student_id")

    def times(name: str) -> Column:
        return (F.col(name) * F.col("_times")).cast("decimal(18,4)")

    return joined.select(
        "student_id",
        "school",
        "grade_level",
        *[times(c).alias(c) for c in sums],
        *[gpa(F.col(c), F.col("credits")).cast("decimal(18,4)").alias(f"{c}_gpa") for c in sums[2:]],
    )


def gpa_audit(sis: Mapping[str, DataFrame], run: AuditRun = AuditRun(), folder: str | None = None) -> DataFrame:
    """The audit: totals, GPAs, both class ranks, their difference and both percentiles."""
    group = ["school", "grade_level"]
    gpas = student_gpas(sis, run)
    gpas = stage(gpas, "student-gpas", folder) if folder else gpas  # ranking stores its rows itself
    ranked = rank_in_group(gpas, group, {"adjusted_gpa": "adjusted_rank", "current_gpa": "current_rank"}, size="students")
    # A group without a school name has ranks but no percentile.
    students = F.when(F.col("school").isNotNull(), F.col("students"))
    headings = {
        "Student ID": F.col("student_id"),
        "School": F.col("school"),
        "Grade Level": F.col("grade_level"),
        "Credits Attempted": F.col("credits"),
        "Credits Earned": F.col("credits_earned"),
        "Unweighted Quality Points": F.col("unweighted"),
        "Adjusted Quality Points": F.col("adjusted"),
        "Current Quality Points": F.col("current"),
        "Unweighted GPA": F.col("unweighted_gpa"),
        "Adjusted Weighted GPA": F.col("adjusted_gpa"),
        "Current Weighted GPA": F.col("current_gpa"),
        "Adjusted Class Rank": F.col("adjusted_rank"),
        "Current Class Rank": F.col("current_rank"),
        "Class Rank Change": F.abs(F.col("current_rank") - F.col("adjusted_rank")),
        "Adjusted Percentile": percent(F.col("adjusted_rank"), students),
        "Current Percentile": percent(F.col("current_rank"), students),
    }
    return ranked.select(*[c.alias(name) for name, c in headings.items()])
