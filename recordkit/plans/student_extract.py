"""One row per student of a chosen set of schools with attendance, referral and test indicators."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from recordkit.functions.rules import band_level, derived_yes_no, flag, growth, masked_id, presence_flag, uploaded_id, yes_no
from recordkit.functions.text import without
from recordkit.operators.joins import left_fan, with_placeholders
from recordkit.operators.keys import latest_per_key
from recordkit.operators.lookup import decode_options, one_option_per_id
from recordkit.operators.measures import ScoreKind, attendance_rate, distinct_events, latest_scores, rate_columns
from recordkit.sources.tables import stage


@dataclass(frozen=True)
class ExtractRun:
    """Fixed values of one run. The label shown for the schools and the offsets that hide ids have no default, so that
    nobody hides ids by known numbers unawares."""

    school_label: str
    id_offsets: tuple[int, ...]
    syear: int = 2021
    school_codes: tuple[str, ...] = ("0051", "0101", "0291")
    learner_codes: tuple[str, ...] = ("LA", "LF", "LY")
    gifted_like: str = "L - %"
    full_year: str = "FY"
    attendance_threshold: int = 90
    passing_level: int = 3


def student_spine(sis: Mapping[str, DataFrame], run: ExtractRun) -> DataFrame:
    """One row per student: the newest enrolment of the year in the chosen schools that ended by
    the end of the full-year period."""
    period = sis["marking_periods"].filter((F.col("short_name") == run.full_year) & (F.col("syear") == run.syear))
    period = period.select("school_id", F.col("end_date").alias("period_end"))
    school = sis["schools"].filter(F.col("custom_327").isin(*run.school_codes)).select(F.col("id").alias("school_id"))
    grades = sis["school_gradelevels"].select(F.col("id").alias("grade_id"), F.col("title").alias("grade"))
    rows = (
        sis["student_enrollment"]
        .filter(F.col("syear") == run.syear)
        .select("student_id", "school_id", "grade_id", "start_date", "end_date")
        .join(school, "school_id")
        .join(period, "school_id")
        .filter(F.coalesce("end_date", "period_end") <= F.col("period_end"))
        .join(grades, "grade_id")
    )
    newest = latest_per_key(rows, ["student_id"], "end_date", ["start_date", "school_id", "grade_id", "period_end", "grade"])
    people = sis["students"].select("student_id", "custom_200000000", "custom_200000001", "custom_626", "custom_2012197500")
    spine = newest.select("student_id", "grade").join(people, "student_id")
    options = one_option_per_id(sis["custom_field_select_options"])
    spine = decode_options(
        spine,
        options,
        {"_gender": ("custom_200000000", "label"), "_race": ("custom_200000001", "label"), "_ell": ("custom_626", "code")},
    )
    category = F.col("custom_2012197500")
    return spine.select(
        "student_id",
        "grade",
        without(F.col("_gender"), "F - ", "M - ").alias("gender"),
        without(F.col("_race"), ", Non-Hispanic", "Other-").alias("race"),
        yes_no(F.col("_ell").isin(*run.learner_codes)).alias("ell"),
        yes_no(category.isNotNull() & ~category.like(run.gifted_like)).alias("ese"),
    )


def newest_scores(sis: Mapping[str, DataFrame], students: DataFrame) -> DataFrame:
    """Per student of ``students`` the newest state achievement levels and local proficiency bands."""
    test, part = F.col("test"), F.col("part")
    local = test.like("APM%") & ~test.like("%Summer%")
    kinds = {
        "fsa_ela": ScoreKind(test.like("%FSA ELA%"), "AL"),
        "fsa_math": ScoreKind(test.ilike("%FSA MATH%"), "AL"),
        "apm_math": ScoreKind(local & (part == "Math Proficiency")),
        "apm_ela": ScoreKind(local & (part == "Reading Proficiency")),
    }
    tables = ("administrations", "tests", "parts", "scores", "score_types")
    return latest_scores(*[sis[f"test_history_{t}"] for t in tables], kinds, students)


def student_extract(sis: Mapping[str, DataFrame], run: ExtractRun) -> DataFrame:
    """The extract. The spine is stored first, and the fact tables keep the rows of its students only, before they are
    shuffled or joined to anything else; every side is then reduced per student. The two uploads are not reduced, and a
    student uploaded twice has two rows."""
    year = F.col("syear") == run.syear
    uploads = {
        "benchmark_ia1_to_ia4_temp": ["ia1_p1", "ia4_p1"],
        "iready_math_upload_temp": ["fall_ss", "spring_ss", "spring_pr", "spring_rp"],
    }
    rows = stage(student_spine(sis, run), "student-spine")
    students = rows.select("student_id")

    def of_spine(table: str) -> DataFrame:
        return sis[table].filter(year).join(students, "student_id", "left_semi")

    sides = [
        attendance_rate(of_spine("attendance_day"), ["student_id"], "state_value"),
        distinct_events(of_spine("discipline_referrals"), ["student_id"], "referral_id"),
        newest_scores(sis, students),
    ]
    for name, columns in uploads.items():
        upload = sis[name].select(uploaded_id(F.col("student_id")).alias("student_id"), *columns).filter("student_id IS NOT NULL")
        rows = rows.join(with_placeholders(upload, students, "student_id"), "student_id")
    full = left_fan(rows, sides, ["student_id"])
    shown_id = masked_id(F.col("student_id"), *run.id_offsets)
    rate = rate_columns(F.col("present"), F.col("total"), run.attendance_threshold)
    ela, math = F.col("fsa_ela.score"), F.col("fsa_math.score")
    benchmark = growth(F.col("ia4_p1"), F.col("ia1_p1"))
    iready = growth(F.col("spring_ss"), F.col("fall_ss"))
    columns = {
        "Student ID": shown_id,
        "School": F.lit(run.school_label),
        "Grade": F.col("grade"),
        "Gender": F.col("gender"),
        "Race": F.col("race"),
        "ELL": F.col("ell"),
        "ESE": F.col("ese"),
        "FRL": derived_yes_no(shown_id),
        "Days Present": F.col("present"),
        "Days Total": F.col("total"),
        "Attendance Rate": rate["rate"],
        "Below 90 Percent Attendance": rate["below_threshold"],
        "Referrals": F.col("events"),
        "Has Referral": presence_flag(F.col("events")),
        "Last FSA ELA AL": ela,
        "Passed FSA ELA": flag(ela >= run.passing_level, ela),
        "Last APM ELA Test Name": F.col("apm_ela.test"),
        "Last APM ELA Proficiency Level Desc": F.col("apm_ela.test_code"),
        "Last APM ELA Proficiency Level": band_level(F.col("apm_ela.test_code")),
        "Benchmark IA1 Score": F.col("ia1_p1"),
        "Benchmark IA4 Score": F.col("ia4_p1"),
        "Benchmark IA Growth": benchmark,
        "Made Benchmark IA Growth": flag(benchmark > 0, benchmark),
        "Last FSA Math AL": math,
        "Passed FSA Math": flag(math >= run.passing_level, math),
        "Last APM Math Test Name": F.col("apm_math.test"),
        "Last APM Math Proficiency Level Desc": F.col("apm_math.test_code"),
        "Last APM Math Proficiency Level": band_level(F.col("apm_math.test_code")),
        "i-Ready Math Fall SS": F.col("fall_ss"),
        "i-Ready Math Spring SS": F.col("spring_ss"),
        "i-Ready Math SS Growth": iready,
        "i-Ready Math Spring Percentile": F.col("spring_pr"),
        "i-Ready Math Spring Placement": F.col("spring_rp"),
        "Made i-Ready Math Growth": flag(iready > 0, iready),
    }
    return full.select(*[c.alias(name) for name, c in columns.items()])
