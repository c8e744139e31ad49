import datetime as dt

import pytest
from helpers import rows
from pyspark.sql import functions as F

from recordkit.functions import rules, text, weeks


def evaluate(spark, schema, values, *columns):
    return rows(spark.createDataFrame(values, schema).select(*columns))


@pytest.mark.parametrize(
    "given, expected",
    [
        ("o'BRIEN-smith", "O'Brien-Smith"),
        ("mc donald  jr.", "Mc Donald  Jr."),
        ("élan 3rd", "Élan 3rd"),
        ("", ""),
        (None, None),
    ],
)
def test_word_capitals(spark, given, expected):
    assert evaluate(spark, "x string", [(given,)], text.word_capitals("x")) == [(expected,)]


def test_full_name_keeps_a_missing_part_empty(spark):
    names = [("O'BRIEN-SMITH", None), (None, "ann")]
    assert evaluate(spark, "l string, f string", names, text.full_name("l", "f")) == [("O'Brien-Smith, ",), (", Ann",)]


def test_joined_text_treats_null_as_empty(spark):
    assert evaluate(spark, "a string, b string", [("x", None), (None, None)], text.join_text("a", "b")) == [("x",), ("",)]


def test_codes_from_labels(spark):
    out = evaluate(
        spark,
        "m string, y string",
        [("052022", "20182019"), (None, None)],
        text.month_year_to_date(F.col("m")),
        text.school_year_code(F.col("y")),
        text.without(F.lit("Other-Black, Non-Hispanic"), ", Non-Hispanic", "Other-"),
    )
    assert out == [("20220501", "1819", "Black"), ("01", "", "Black")]


@pytest.mark.parametrize("given, expected", [(12.0, "12"), (12.5, "12.5"), (100.0, "100"), (0.05, "0.05"), (0.0, "0"), (33.335, "33.34"), (1234567.891, "1234567.89")])
def test_short_number(spark, given, expected):
    assert evaluate(spark, "x double", [(given,)], text.short_number(F.col("x"))) == [(expected,)]


def test_flags(spark):
    x = F.col("x")
    out = evaluate(spark, "x int", [(5,), (1,), (None,)], rules.flag(x > 3, x), rules.presence_flag(x), rules.yes_no(x > 3))
    assert out == [(1, 1, "Yes"), (0, 1, "No"), (None, 0, "No")]


def test_change_flag_needs_both_sides(spark):
    pairs = [("a", "b"), ("a", "a"), (None, "a"), ("a", None)]
    assert evaluate(spark, "l string, r string", pairs, rules.change_flag(F.col("l"), F.col("r"))) == [("Y",), (None,), (None,), (None,)]


def test_any_flag(spark):
    pairs = [("Y", None), (None, None), (None, "Y")]
    assert evaluate(spark, "l string, r string", pairs, rules.any_flag([F.col("l"), F.col("r")])) == [("Y",), (None,), ("Y",)]


def test_band_level(spark):
    names = [("Inadequate",), ("Mastery",), ("Unknown",), (None,)]
    assert evaluate(spark, "x string", names, rules.band_level(F.col("x"))) == [(1,), (5,), (None,), (None,)]


def test_growth_and_rejects(spark):
    scores = [("12", "5"), ("", "5"), ("absent", "5"), (None, "5"), ("5", "12")]
    out = evaluate(spark, "l string, e string", scores, rules.growth(F.col("l"), F.col("e")), rules.is_reject(F.col("l")))
    assert out == [(7, False), (None, True), (None, True), (None, False), (-7, False)]


def test_uploaded_id_matches_only_the_same_text(spark):
    ids = [("43",), ("043",), (" 43",), ("x",), (None,)]
    assert evaluate(spark, "x string", ids, rules.uploaded_id(F.col("x"))) == [(43,), (None,), (None,), (None,), (None,)]


def test_rounding_happens_once(spark):
    # 1/3 of 100 and a quotient whose sixth digit would round the fourth up.
    out = evaluate(spark, "p int, w int", [(1, 3), (1, 0), (2, 3)], rules.percent(F.col("p"), F.col("w")))
    assert [None if v[0] is None else float(v[0]) for v in out] == [33.33, None, 66.67]
    tricky = evaluate(spark, "p int, w int", [(9999995, 2222222)], rules.ratio(F.col("p"), F.col("w")))
    assert float(tricky[0][0]) == round(9999995 / 2222222, 4)


@pytest.mark.parametrize("given, expected", [(2, "Yes"), (7, "Yes"), (9, "Yes"), (11, "No"), (13, "No"), (27, "Yes"), (0, "Yes")])
def test_masked_id_and_derived_flag(spark, given, expected):
    shown = rules.masked_id(F.col("x"), 4300000000, 200420)
    assert evaluate(spark, "x long", [(4300200420 + given,)], shown, rules.derived_yes_no(shown)) == [(given, expected)]


@pytest.mark.parametrize(
    "day, monday, sunday",
    [("2024-01-29", 0, 0), ("2024-01-28", -1, 0), ("2024-01-22", -1, -1), ("2024-01-21", -2, -1), ("2024-02-05", 1, 1), ("1969-12-29", -2822, -2822)],
)
def test_week_offset(spark, day, monday, sunday):
    as_of = dt.date(2024, 1, 29)
    columns = [weeks.week_offset(F.col("x").cast("date"), as_of, s) for s in ("monday", "sunday")]
    assert evaluate(spark, "x string", [(day,)], *columns) == [(monday, sunday)]


PERCENT = "<b><span style='color:#333333'>{}%</span></b> compared to the prior week."


@pytest.mark.parametrize(
    "last, prior, expected, strict",
    [
        (15.0, 10.0, "Your time to resolution last week declined " + PERCENT.format("50"), None),
        (10.0, 15.0, "Your time to resolution last week improved " + PERCENT.format("33.33"), None),
        (10.0, 10.0, "[DATA UNABLE TO BE PULLED]", None),
        (None, 10.0, "No comparison can be done due to one of the past two weeks having no data.", None),
        (10.0, 0.0, "No comparison can be done due to one of the past two weeks having no data.", None),
        (
            None,
            None,
            "No comparison can be done due to one of the past two weeks having no data.",
            "There have been no resolution times recorded in the past two weeks.",
        ),
    ],
)
def test_week_over_week_text(spark, last, prior, expected, strict):
    p, q = F.col("p"), F.col("q")
    out = evaluate(spark, "p double, q double", [(last, prior)], weeks.week_over_week_text(p, q), weeks.week_over_week_text(p, q, strict_blank=True))
    assert out == [(expected, strict or expected)]


@pytest.mark.parametrize(
    "seconds, shown, exact",
    [
        (None, "Immediate", "Immediate"),
        (0.0, "Immediate", "Immediate"),
        (59.0, "59s", "59s"),
        (59.6, "60s", "1m 0s"),
        (119.7, "1m 60s", "2m 0s"),
        (3661.0, "1h 1m 1s", "1h 1m 1s"),
        (7260.0, "2h 0m 60s", "2h 1m 0s"),
        (86400.0, "1d 0h 0m 0s", "1d 0h 0m 0s"),
        (90061.0, "1d 1h 1m 1s", "1d 1h 1m 1s"),
        (200000.0, "2d 7h 33m 20s", "2d 7h 33m 20s"),
    ],
)
def test_duration_text(spark, seconds, shown, exact):
    frame = spark.createDataFrame([(seconds, 3, 0)], "s double, n int, none int")
    for tickets, name, how in (("n", "shown", False), ("n", "exact", True), ("none", "empty", False)):
        frame = weeks.with_duration_text(frame, "s", tickets, name, how)
    assert rows(frame.select("shown", "exact", "empty")) == [(shown, exact, "N/A")]
