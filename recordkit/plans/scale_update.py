"""Move courses from the 5.0 to the 7.0 scale: two staged tables and two keyed updates."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from recordkit.operators.grades import DECIMAL, UNMAPPED_POINTS, first_rule, scale_points
from recordkit.operators.updates import FileUpdate, keyed_update, keyed_update_files
from recordkit.sources.tables import new_folder, stage, write_version
from recordkit.sources.versions import Version

# Scale titles before and after, the below-level title, the points of an A per
# scale, and the letters that earn no points.
NEW_TITLES = {
    "Weight 5 AP IB AICE DE": "Weight 7 AP DE IB",
    "Weight 4.5 Honors & Advanced": "Weight 6 Honors & Advanced",
    "Weight 4 On Level": "Weight 5 On Level",
}
BELOW_LEVEL = "Weight 4 Below Level"
# Columns of a course that tell its row, and their names in the staged table.
_SAME = ("student_id", "syear", "course_num", "course_title", "marking_period_id", "report_card_grade_id")
GRADE_KEYS = {**{c: c for c in _SAME}, "custom_7": "grade"}
SCALES = {"Weight 7 AP DE IB": 7, "Weight 6 Honors & Advanced": 6, "Weight 5 On Level": 5, BELOW_LEVEL: 4}
ZERO_LETTERS = ("F", "P", "T", "I", "W", "WP")


@dataclass(frozen=True)
class ScaleRun:
    """Fixed values of one run."""

    syear: int = 2021
    first_new_year: int = 2021
    below_level_like: str = "79%"
    grades: tuple[str, ...] = ("10", "11", "12")


@dataclass(frozen=True)
class ScaleUpdate:
    """The four written tables, the conflicts of both updates and the rows with the 99 sentinel."""

    course_history_update: DataFrame
    report_card_grade_scales: DataFrame
    course_history_weighted_gpa_points_update: DataFrame
    student_report_card_grades: DataFrame
    scale_conflicts: DataFrame
    grade_conflicts: DataFrame
    unmapped: DataFrame


def _graded_courses(grades: DataFrame, scales: DataFrame, periods: DataFrame, run: ScaleRun) -> DataFrame:
    """Credit-bearing course history of the year with its scale title and marking period."""
    titles = scales.select(F.col("id").alias("grade_scale_id"), F.col("title").alias("grade_scale"))
    named = periods.select(F.col("marking_period_id").cast("string").alias("marking_period_id"), F.col("title").alias("mp"))
    wanted = (
        (F.col("course_history") == "Y") & (F.col("affects_gpa") == "Y") & (F.col("credits") != 0) & (F.col("syear") == run.syear)
    )
    return grades.filter(wanted).join(titles, "grade_scale_id").join(named, "marking_period_id")


def target_titles(courses: DataFrame, run: ScaleRun) -> DataFrame:
    """First staged table: each course with the title its scale should have."""
    new_year = F.col("syear") >= run.first_new_year
    rules = [(new_year & F.col("course_num").like(run.below_level_like), F.lit(BELOW_LEVEL))]
    rules += [(new_year & (F.col("grade_scale") == old), F.lit(new)) for old, new in NEW_TITLES.items()]
    return courses.select(
        "student_id", "syear", "school_id", "course_title", "course_num", "credits", "credits_earned", "grade_title",
        "grade_scale", "grade_scale_id",
        first_rule(rules, F.col("grade_scale")).alias("seven_scale_value"),
        F.col("custom_7").alias("grade"), "mp", "updated_at",
    )


def target_points(courses: DataFrame, run: ScaleRun) -> DataFrame:
    """Second staged table: each course of the chosen grades with the points it should have."""
    chosen = courses.filter(F.col("custom_7").isin(*run.grades))
    pointed = scale_points(chosen, "grade_scale", "grade_title", "updated_weighted_gpa_points", SCALES, ZERO_LETTERS)
    return pointed.select(
        "student_id", "syear", "school_id", "marking_period_id", "report_card_grade_id", "course_title", "course_num",
        "credits", "credits_earned", "grade_title", "grade_scale", "weighted_gpa_points", "updated_weighted_gpa_points",
        F.col("custom_7").alias("grade"),
    )


def scale_update(sis: Mapping[str, DataFrame], run: ScaleRun = ScaleRun(), folder: str | None = None) -> ScaleUpdate:
    """Run the four steps; each writes a new table below ``folder`` and the next one reads it.

    The scale table is shared: a title changed because of grades 10-12 also holds for grade 9.
    Where one scale is offered several titles, the most frequent wins and the rest are conflicts.
    """
    grades, scales, periods = (sis[n] for n in ("student_report_card_grades", "report_card_grade_scales", "marking_periods"))
    folder = folder or new_folder(grades.sparkSession, "scale-update")

    titles = stage(target_titles(_graded_courses(grades, scales, periods, run), run), "course_history_update", folder)
    offered = titles.filter(F.col("grade").isin(*run.grades))
    scale_change = keyed_update(scales, offered, {"id": "grade_scale_id"}, "title", "seven_scale_value")
    new_scales = write_version(scale_change.table, scales, folder, "report_card_grade_scales")

    points = target_points(_graded_courses(grades, new_scales, periods, run), run)
    points = stage(points, "course_history_weighted_gpa_points_update", folder)
    grade_change = keyed_update(grades, points, GRADE_KEYS, "weighted_gpa_points", "updated_weighted_gpa_points", lambda c: c.cast(DECIMAL))
    new_grades = write_version(grade_change.table, grades, folder, "student_report_card_grades")
    return ScaleUpdate(
        titles,
        new_scales,
        points,
        new_grades,
        scale_change.conflicts,
        grade_change.conflicts,
        points.filter(F.col("updated_weighted_gpa_points") == UNMAPPED_POINTS),
    )


def publish_scale_update(scales: Version, grades: Version, periods: DataFrame, run: ScaleRun = ScaleRun()) -> tuple[FileUpdate, FileUpdate]:
    """The same four steps on stored tables: only files with a changed row are written anew, and each new version is published in one step.

    The scales are published before the points are chosen, as the second staged table reads the new titles.
    """
    spark = periods.sparkSession
    titles = stage(target_titles(_graded_courses(grades.read(spark), scales.read(spark), periods, run), run), "course_history_update")
    new_scales = keyed_update_files(scales, titles.filter(F.col("grade").isin(*run.grades)), {"id": "grade_scale_id"}, "title", "seven_scale_value")
    points = stage(target_points(_graded_courses(grades.read(spark), new_scales.version.read(spark), periods, run), run), "course_history_weighted_gpa_points_update")
    return new_scales, keyed_update_files(grades, points, GRADE_KEYS, "weighted_gpa_points", "updated_weighted_gpa_points", lambda c: c.cast(DECIMAL))
