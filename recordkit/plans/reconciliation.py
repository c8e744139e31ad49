"""Compare an uploaded state file with the system, column by column, with change dates."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from recordkit.functions.rules import any_flag, uploaded_id
from recordkit.functions.text import date_text, join_text, month_year_to_date, pad_zeros, school_year_code
from recordkit.operators.changes import ColumnPair, compare_columns, last_change_dates, packed_code, where_changed
from recordkit.operators.joins import left_fan, with_placeholders
from recordkit.operators.keys import active_or_latest
from recordkit.operators.lookup import decode_options, one_option_per_id
from recordkit.sources.tables import stage

# Log types, the padding code, and per compared item the text that the audit log
# holds when the item was changed.
DISABILITY_LOG = 457
PREVENTION_LOG = 312
NO_CODE = "Z"
CODE_WIDTH = 10
LOG_PATTERNS = {
    "zoned_district": "%CUSTOM_821%",
    "zoned_school": "%CUSTOM_822%",
    "primary_ese_code": "%LOG_FIELD4%",
    "other_ese_code": "%LOG_FIELD6%",
    "grade_level": "%GRADE_ID%",
    "ell_code": "%CUSTOM_626%",
}
TESTED_GRADES = ("10", "11", "12")
HIGH_SCHOOL = ("09", "10", "11", "12")
REQUIREMENT_MET = ("Y", "YC", "YW")
TYPE_TO_FILL_IN = "NEED TYPE"


@dataclass(frozen=True)
class ReconciliationRun:
    """The school year, the day the survey closed, and whether to keep the original quirk that the
    date of an other-code change is shown only if the primary code changed as well."""

    syear: int = 2021
    survey_end: dt.date = dt.date(2022, 2, 18)
    faithful: bool = True


def file_ids(sis: Mapping[str, DataFrame]) -> DataFrame:
    """The different state ids of the file; only they can appear in the result."""
    return sis["student_data_updates_temp"].select("fleid").filter("fleid IS NOT NULL").distinct()


def last_enrollment(sis: Mapping[str, DataFrame], run: ReconciliationRun) -> DataFrame:
    """Open enrolments, or the newest one that ended since the survey, of main schools, of the
    people in the file."""
    end = F.col("end_date")
    rows = (
        sis["student_enrollment"]
        .filter(
            (F.col("syear") == run.syear)
            & (end.isNull() | (end >= F.lit(run.survey_end).cast("date")))
            & (F.coalesce("custom_9", F.lit("N")) == "N")
        )
        .select("student_id", "school_id", "grade_id", "drop_code", "start_date", "end_date")
    )
    people = sis["students"].select("student_id", F.col("custom_200000224").alias("fleid")).join(file_ids(sis), "fleid", "left_semi")
    rows = rows.join(people.select("student_id"), "student_id", "left_semi")
    school = sis["schools"].select(F.col("id").alias("school_id"), F.col("title").alias("school"), F.col("custom_327").alias("school_num"))
    grade = sis["school_gradelevels"].select(F.col("id").alias("grade_id"), F.col("title").alias("grade"))
    code = sis["student_enrollment_codes"].select(F.col("id").alias("drop_code"), F.col("title").alias("drop_title"))
    rows = rows.join(school, "school_id").join(grade, "grade_id").join(code, "drop_code", "left")
    shown = ["start_date", "drop_title", "grade", "school", "school_num"]
    rows = rows.select("student_id", "end_date", *shown)
    return active_or_latest(rows, ["student_id"], "end_date", shown).join(people, "student_id")


def disability_codes(sis: Mapping[str, DataFrame], enrolled: DataFrame, options: DataFrame) -> DataFrame:
    """Packed code per state id; an enrolled person without codes gets the padding only, and each
    enrolment row repeats the codes."""
    entries = (
        sis["custom_field_log_entries"]
        .filter((F.col("field_id") == DISABILITY_LOG) & F.col("log_field12").isNull())
        .select(
            F.col("source_id").alias("student_id"),
            uploaded_id(F.col("log_field3")).alias("_code_id"),
            uploaded_id(F.col("log_field6")).alias("_type_id"),
            F.coalesce("log_field4", F.lit("N")).alias("_role"),
        )
        .join(enrolled.select("student_id"), "student_id", "left_semi")
        .groupBy("student_id", "_code_id", "_type_id", "_role")
        .agg(F.count(F.lit(1)).alias("_entries"))
    )
    entries = decode_options(entries, options, {"_type": ("_type_id", "code"), "_code": ("_code_id", "code")})
    entries = entries.filter((F.col("_type") == "A") & F.col("_code").isNotNull()).select("student_id", "_code", "_role", "_entries")
    people = enrolled.groupBy("student_id", "fleid").agg(F.count(F.lit(1)).alias("_times"))
    joined = people.join(entries, "student_id", "left").withColumn("_copies", F.col("_times") * F.col("_entries"))
    is_primary = F.col("_role") == "Y"
    return packed_code(joined, ["fleid"], "_code", is_primary, ~is_primary, CODE_WIDTH, NO_CODE, copies="_copies")


def prevention_programs(sis: Mapping[str, DataFrame], enrolled: DataFrame, options: DataFrame, run: ReconciliationRun) -> DataFrame:
    """Active prevention programs per state id, with the start if it is since the survey."""
    entries = (
        sis["custom_field_log_entries"]
        .filter((F.col("field_id") == PREVENTION_LOG) & (F.col("log_field2") == "Y") & F.col("log_field5").isNull())
        .select(F.col("source_id").alias("student_id"), uploaded_id(F.col("log_field1")).alias("_program_id"), F.col("log_field4").try_cast("date").alias("_from"))
        .join(enrolled.select("student_id"), "student_id", "left_semi")
        .distinct()
    )
    entries = decode_options(entries, options, {"dop_program": ("_program_id", "code")})
    started = F.when(F.col("_from") >= F.lit(run.survey_end).cast("date"), date_text("_from"))
    people = enrolled.select("student_id", "fleid").distinct()
    return entries.join(people, "student_id").select("fleid", "dop_program", started.alias("dop_date")).distinct()


def change_dates(sis: Mapping[str, DataFrame], run: ReconciliationRun) -> DataFrame:
    """Per state id and audited item: the different dates of last change of the people who share
    the id (one person, one date, unless the id is used twice)."""
    people = sis["students"].select("student_id", F.col("custom_200000224").alias("fleid")).join(file_ids(sis), "fleid", "left_semi")
    editors = sis["users"].select(F.col("staff_id").alias("user_id"))
    entries = sis["database_object_log"].join(people.select("student_id"), "student_id", "left_semi")
    dates = last_change_dates(entries, "student_id", LOG_PATTERNS, run.survey_end, editors)
    per_item = [F.collect_set(date_text(item)).alias(f"_{item}_dates") for item in LOG_PATTERNS]
    return dates.join(people, "student_id").groupBy("fleid").agg(*per_item)


def system_side(sis: Mapping[str, DataFrame], run: ReconciliationRun) -> DataFrame:
    """Everything the system knows per state id of the file; an unknown id has a row as well.

    Programs have at most one row per code and day, codes and dates one row per id.
    """
    options = one_option_per_id(sis["custom_field_select_options"])
    enrolled = stage(last_enrollment(sis, run), "last-enrollment")
    people = sis["students"].filter("custom_200000224 IS NOT NULL").select(
        F.col("custom_200000224").alias("fleid"),
        "custom_821", "custom_822", "custom_626", "custom_71", "custom_200000244", "custom_1429", "custom_196", "custom_2012197376",
    )
    decoded = {
        "_district": ("custom_821", "code"),
        "_zoned_school": ("custom_822", "code"),
        "_ell": ("custom_626", "code"),
        "_lunch": ("custom_71", "code"),
        "_requirement": ("custom_200000244", "code"),
        "_ninth_label": ("custom_1429", "label"),
    }
    people = decode_options(people, options, decoded).select("fleid", *decoded, "custom_196", "custom_2012197376")
    in_file = file_ids(sis)
    known = in_file
    for side in (people, enrolled.drop("student_id").withColumnRenamed("withdrawn", "_withdrawn")):
        known = known.join(with_placeholders(side, in_file, "fleid"), "fleid")
    reduced = [
        disability_codes(sis, enrolled, options).withColumnRenamed("code", "_ese"),
        prevention_programs(sis, enrolled, options, run),
        change_dates(sis, run),
    ]
    return left_fan(known, reduced, ["fleid"])


def reconciliation(sis: Mapping[str, DataFrame], run: ReconciliationRun = ReconciliationRun(), system_name: str = "focus", file_name: str = "doe") -> DataFrame:
    """The 63-column comparison, one row per different outcome.

    ``system_name`` and ``file_name`` prefix the compared columns. The system side is written once
    and joined once to the file, so that a state id that fills a third of the file is split by the
    adaptive join (every id of the file is on the system side, so an inner join loses none); file
    rows without an id take no part in it.
    """
    system = stage(system_side(sis, run), "system-side")
    file = sis["student_data_updates_temp"]
    with_id = file.filter("fleid IS NOT NULL").join(system, "fleid")
    rows = with_id.unionByName(file.filter("fleid IS NULL"), allowMissingColumns=True)

    def f(name: str) -> Column:
        return F.col(name)

    def no_zero(name: str) -> Column:
        return F.nullif(f(name), F.lit("0"))

    def names(item: str) -> tuple[str, str, str]:
        return f"{file_name}_{item}", f"{system_name}_{item}", f"{item}_change"

    def pair(item: str, left: Column, right: Column, compare_left=None, compare_right=None, only_if=None) -> ColumnPair:
        left_name, right_name, flag_name = names(item)
        return ColumnPair(left_name, left, right_name, right, flag_name, compare_left, compare_right, only_if)

    grade = pad_zeros("grade", 2)
    enrolled_school = pad_zeros("school_of_enrollment", 4)
    primary = F.left(f("_ese"), F.lit(1))
    others = F.substring(f("_ese"), 2, CODE_WIDTH)
    shown_others = F.when(primary == NO_CODE, None).otherwise(others)
    file_others = F.substring(no_zero("ese_code"), 2, 2**31 - 1)
    requirement = (
        F.when(~f("grade").isin(*TESTED_GRADES), NO_CODE).when(f("_requirement").isin(*REQUIREMENT_MET), "Y").otherwise("N")
    )
    ninth = school_year_code(f("_ninth_label"))
    withdrawn = F.coalesce(f("_withdrawn"), F.lit("N"))
    pairs = [
        pair("zoned_district", pad_zeros("zoned_district", 2), F.coalesce("_district", F.lit("00"))),
        pair("zoned_school", pad_zeros("zoned_school", 4), F.coalesce("_zoned_school", F.lit("0000"))),
        pair("grade_level", pad_zeros("grade_level", 2), grade),
        pair(
            "primary_ese_code",
            F.left(no_zero("ese_code"), F.lit(1)),
            F.nullif(primary, F.lit(NO_CODE)),
            F.when(f("ese_code") == "0", NO_CODE).otherwise(F.left(f("ese_code"), F.lit(1))),
            primary,
        ),
        pair("other_ese_code", file_others, shown_others),
        pair("ell_code", f("ell_code"), f("_ell")),
        pair("lunch_status", f("lunch_status"), f("_lunch")),
        pair("ela_met", f("met_grade_10_ela_reading_requirement"), requirement),
        pair("dop_code", f("dropout_prevention_juvenile_justice_program_code"), f("dop_program")),
        pair("ye9", no_zero("year_entered_ninth_grade"), ninth, f("year_entered_ninth_grade"), ninth, grade.isin(*HIGH_SCHOOL)),
        ColumnPair("school_of_enrollment", enrolled_school, "_school_num", f("school_num"), "school_change"),
        ColumnPair(f"{file_name}_withdrawn", f("withdrawn"), f"{system_name}_withdrawn", withdrawn, "withdrawn_change"),
    ]
    carried = [
        "record_id", "district_of_enrollment", "student_last_name", "student_first_name", "fleid", "date_of_birth",
        "sex", "race", "full_year_school", "full_year_district", "ext_med",
    ]
    helpers = ["start_date", "end_date", "drop_title", "school", "dop_date", "custom_196", "custom_2012197376"]
    arrays = [f"_{item}_dates" for item in LOG_PATTERNS]
    compared = rows.select(
        *carried,
        *compare_columns(pairs),
        f("withdrawn_from").alias(f"{file_name}_withdrawn_from"),
        no_zero("withdrawal_date").alias(f"{file_name}_withdrawal_date"),
        *helpers,
        *arrays,
    )
    flags = [p.flag_name for p in pairs]
    for item in LOG_PATTERNS:
        dates = where_changed(f"{item}_change", f(f"_{item}_dates"))
        if item == "other_ese_code" and run.faithful:
            dates = where_changed("primary_ese_code_change", dates)
        compared = compared.select("*", F.explode_outer(dates).alias(f"{item}_change_date")).drop(f"_{item}_dates")
    dependent = {
        "lunch_status_change_date": where_changed("lunch_status_change", f("custom_2012197376")),
        "ela_met_change_date": where_changed("ela_met_change", month_year_to_date(f("custom_196"))),
        "dop_code_change_date": where_changed("dop_code_change", f("dop_date")),
        "school_current": where_changed("school_change", f("school")),
        "school_current_start_date": where_changed("school_change", f("start_date")),
        "withdrawn_change_code": where_changed("withdrawn_change", f("drop_title")),
        "withdrawn_change_from": where_changed("withdrawn_change", F.lit(TYPE_TO_FILL_IN)),
        "withdrawn_change_date": where_changed("withdrawn_change", f("end_date")),
    }
    full = compared.withColumns(dependent).withColumn("has_change", any_flag([f(n) for n in flags]))

    def block(item: str, date: bool = True) -> list[str]:
        return [*names(item), *([f"{item}_change_date"] if date else [])]

    order = ["has_change", *carried[:2], "school_of_enrollment", *carried[2:]]
    for item in ["zoned_district", "zoned_school", "grade_level", "primary_ese_code", "other_ese_code", "ell_code", "lunch_status", "ela_met", "dop_code"]:
        order += block(item)
    order += [f"{file_name}_withdrawn", f"{file_name}_withdrawn_from", f"{file_name}_withdrawal_date", f"{system_name}_withdrawn"]
    order += ["school_change", "school_current", "school_current_start_date"]
    order += ["withdrawn_change", "withdrawn_change_code", "withdrawn_change_from", "withdrawn_change_date"]
    return full.select(*order, *block("ye9", date=False)).distinct()
