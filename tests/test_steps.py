import datetime as dt
from decimal import Decimal

import pytest
from helpers import bag, by_key, day, rows
from pyspark.sql import functions as F

from recordkit.operators.grades import credit_totals, enrolled_at_period_end, gpa, quality_points, scale_points
from recordkit.operators.joins import left_fan, left_join_where, small_lookup, with_placeholders
from recordkit.operators.lookup import decode_options, one_option_per_id
from recordkit.operators.measures import attendance_rate, distinct_events, rate_columns
from recordkit.operators.reshape import unpivot_scores
from recordkit.operators.tickets import Week, channel_counts, mean_duration, week_over_week
from recordkit.operators.updates import keyed_update
from recordkit.operators.uploads import rejected_values
from recordkit.operators.windows import AssessmentWindow, course_member, school_member


def test_attendance_rate_and_flag(spark):
    days = [(1, 1)] * 9 + [(1, 0)] + [(2, 1)] * 8 + [(2, 0)] + [(2, None)] + [(3, None)]
    counted = attendance_rate(spark.createDataFrame(days, "k int, v int"), ["k"], "v")
    out = by_key(counted.withColumns(rate_columns(F.col("present"), F.col("total"), 90)), "k")
    assert [(float(out[k]["rate"]), out[k]["below_threshold"]) for k in (1, 2)] == [(90.0, 0), (88.89, 1)]
    assert out[3]["total"] == 0 and out[3]["rate"] is None and out[3]["below_threshold"] is None


def test_distinct_events(spark):
    frame = spark.createDataFrame([(1, 5), (1, 5), (1, 6), (2, 7), (3, None)], "k int, r int")
    assert sorted(rows(distinct_events(frame, ["k"], "r"))) == [(1, 2), (2, 1), (3, 0)]


def test_scale_points(spark):
    pairs = [("7", "A"), ("7", "D"), ("4", "D"), ("7", "F"), ("3", "F"), ("3", "A"), ("7", "Q"), (None, "A"), ("7", None), (None, "P")]
    frame = spark.createDataFrame(pairs, "s string, l string")
    out = scale_points(frame, "s", "l", "points", {"7": 7, "4": 4}, ("F", "P"))
    assert {(r["s"], r["l"]): r["points"] for r in out.collect()} == dict(zip(pairs, [7, 4, 1, 0, 0, 99, 99, 99, 99, 0]))


def test_quality_points_and_gpa(spark):
    frame = spark.createDataFrame([(Decimal("0.3335"), 3, Decimal("0")), (Decimal("1"), None, Decimal("3"))], "c decimal(18,4), p int, t decimal(18,4)")
    out = frame.select(quality_points(F.col("c"), F.col("p")), gpa(F.lit(2), F.col("t")))
    assert rows(out) == [(Decimal("1.001"), None), (None, Decimal("0.6667"))]


def test_enrolled_at_period_end(spark):
    last = day("2022-05-31")
    ends = [None, day("2022-05-21"), day("2022-05-20"), last, day("2022-06-01")]
    frame = spark.createDataFrame([(i, e, last) for i, e in enumerate(ends)], "id int, e date, p date")
    assert sorted(r["id"] for r in enrolled_at_period_end(frame, "e", "p").collect()) == [0, 1, 3]


def test_decode_options(spark):
    options = one_option_per_id(spark.createDataFrame([(1, "F", "F - Female"), (2, "M", "M - Male"), (2, "X", "again")], "id long, code string, label string"))
    frame = spark.createDataFrame([(10, 1), (11, 2), (12, 3), (13, None)], "k int, g long")
    out = decode_options(frame, options, {"code": ("g", "code"), "label": ("g", "label")})
    assert sorted(rows(out.select("k", "code", "label"))) == [(10, "F", "F - Female"), (11, "M", "M - Male"), (12, None, None), (13, None, None)]


def test_a_large_lookup_is_not_broadcast(spark):
    def hinted(limit):
        return "broadcast" in small_lookup(spark.range(50), limit)._jdf.queryExecution().logical().toString()

    assert hinted(50) and not hinted(49)


def test_joins_keep_the_left_side(spark):
    spine = spark.createDataFrame([(1, "Y"), (2, None)], "k int, f string")
    side = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    twice = spark.createDataFrame([(1, 5), (1, 6)], "k int, w int")
    assert sorted(rows(left_fan(spine, [side, twice], ["k"])), key=str) == [(1, "Y", "a", 5), (1, "Y", "a", 6), (2, None, "b", None)]
    right = side.select(F.col("k").alias("rk"), "v")
    out = left_join_where(spine, right, (F.col("k") == F.col("rk")) & (F.col("f") == "Y"), ["rk"])
    assert sorted(rows(out), key=str) == [(1, "Y", "a"), (2, None, None)]


def test_placeholders_keep_every_key(spark):
    side = spark.createDataFrame([(1, "a"), (1, "b"), (9, "c")], "k int, v string")
    keys = spark.createDataFrame([(1,), (2,)], "k int")
    out = with_placeholders(side, keys, "k")
    assert sorted(rows(keys.join(out, "k")), key=str) == sorted(rows(keys.join(side, "k", "left")), key=str)


def test_unpivot_of_more_than_99_questions(spark):
    columns = [f"_{i}" for i in range(1, 121)]
    sheet = spark.createDataFrame([("s1", "9", *map(str, range(1, 121)))], "student string, total string, " + ", ".join(f"{c} string" for c in columns))
    key = spark.createDataFrame([(q, f"k{int(q)}") for q in ("000", "0", "1", "09", "10", "100", "101", "0120", "121", "1000")], "question string, standard string")
    out = unpivot_scores(sheet, ["student"], "total", columns, key, ["standard"]).select("question", "score", "answer", "standard")
    overall = [("Overall Score", "9", None, "k0")] * 2
    assert bag(out) == bag(spark.createDataFrame(overall + [(f"{n:03d}", None, str(n), f"k{n}") for n in (1, 9, 10, 100, 101, 120)], out.schema))


def test_sums_before_narrowing(spark):
    frame = spark.createDataFrame([("a", "0.33333")] * 2 + [("a", "0.00003")], "k string, text string").withColumn("v", F.col("text").cast("decimal(12,5)"))
    assert str(credit_totals(frame, ["k"], ["v"]).first()["v"]) == "0.6667"
    assert str(attendance_rate(frame, ["k"], "v").first()["present"]) == "0.6667"


def test_means_of_small_and_large_numbers(spark):
    day = dt.date(2024, 1, 31)
    week = Week(day)
    for last, prior, told in ((4e-7, 1e-7, "declined"), (1e12, 4e12, "improved"), (1e300, 2e300, "improved")):
        frame = spark.createDataFrame([(day - dt.timedelta(7), last), (day - dt.timedelta(14), prior)], "day date, v double")
        message = week_over_week(frame, "day", "v", week).first()["message"]
        assert told in message and ("300%" in message or "75%" in message or "50%" in message)


def test_unpivot_scores(spark):
    sheet = spark.createDataFrame([("s1", "80", "1", None), ("s2", None, "0", "1")], "student string, total string, _1 string, _2 string")
    key = spark.createDataFrame([("1", "A"), ("1", "B")], "question string, standard string")  # two rows for 01, none for 00 and 02
    out = unpivot_scores(sheet, ["student"], "total", ["_1", "_2"], key, ["standard"])
    assert bag(out) == bag(
        spark.createDataFrame(
            [
                ("s1", "Overall Score", "80", None, None),
                ("s2", "Overall Score", None, None, None),
                ("s1", "01", None, "1", "A"),
                ("s1", "01", None, "1", "B"),
                ("s2", "01", None, "0", "A"),
                ("s2", "01", None, "0", "B"),
            ],
            "student string, question string, score string, answer string, standard string",
        )
    )
    full_key = spark.createDataFrame([("0", "all"), ("1", "A"), ("2", "B")], "question string, standard string")
    out = unpivot_scores(sheet, ["student"], "total", ["_1", "_2"], full_key, ["standard"])
    assert out.count() == 6 and out.filter("question = '02' AND answer IS NULL").count() == 1
    assert out.filter("question = 'Overall Score' AND standard = 'all'").count() == 2


def test_window_membership(spark):
    w = AssessmentWindow(dt.date(2021, 8, 11), dt.date(2022, 3, 7), dt.date(2022, 3, 11))
    cases = [  # start, end, newest by start, newest by end -> course, school
        ("2021-08-11", None, False, False, True, True),
        ("2022-03-08", None, False, False, False, False),
        ("2021-08-11", "2022-03-09", False, False, True, False),
        ("2021-08-11", "2022-03-09", True, False, True, True),
        ("2021-08-11", "2022-03-06", False, False, False, False),
        ("2021-08-11", "2022-03-06", False, True, True, True),
        ("2021-08-10", "2022-03-06", False, True, False, False),
        ("2022-03-08", "2022-04-01", False, True, False, True),
    ]
    frame = spark.createDataFrame([(day(s), day(e), a, b) for s, e, a, b, _, _ in cases], "s date, e date, a boolean, b boolean")
    s, e, a, b = (F.col(c) for c in "seab")
    out = frame.select(F.coalesce(course_member(w, s, e, b), F.lit(False)), F.coalesce(school_member(w, s, e, a, b), F.lit(False)))
    assert rows(out) == [(c, m) for *_, c, m in cases]


def test_keyed_update(spark):
    target = spark.createDataFrame([(1, "a", 5), (2, "b", 6), (2, "b", 7), (3, None, 8), (None, "n", 9)], "id int, title string, x int")
    source = spark.createDataFrame([(1, "new"), (2, "q"), (2, "p"), (2, "q"), (4, "z"), (None, "never"), (3, "m"), (3, "l")], "k int, v string")
    result = keyed_update(target, source, {"id": "k"}, "title", "v")
    assert bag(result.table) == bag(spark.createDataFrame([(1, "new", 5), (2, "q", 6), (2, "q", 7), (3, "l", 8), (None, "n", 9)], target.schema))
    assert sorted(rows(result.conflicts.select("k", "v", "choices"))) == [(2, "q", 2), (3, "l", 2)]
    again = keyed_update(result.table, source, {"id": "k"}, "title", "v")
    assert bag(again.table) == bag(result.table)


WEEK = Week(dt.date(2024, 1, 31))


def test_week_over_week(spark):
    facts = [("up", "2024-01-22", 15.0), ("up", "2024-01-21", 10.0), ("up", "2024-01-29", 999.0), ("gone", "2024-01-21", 4.0), ("null", "2024-01-22", None)]
    frame = spark.createDataFrame([(k, day(d), v) for k, d, v in facts], "k string, d date, v double")
    out = by_key(week_over_week(frame, "d", "v", WEEK, by=["k"]), "k")
    assert "declined <b><span style='color:#333333'>50%" in out["up"]["message"]
    assert out["gone"]["message"].startswith("No comparison") and out["null"]["message"].startswith("No comparison")
    assert rows(week_over_week(frame.filter("false"), "d", "v", WEEK, strict_blank=True))[0][0].startswith("There have been no")


def test_mean_duration(spark):
    facts = [("a", "2024-01-22", 59.0, 1), ("a", "2024-01-23", 60.4, 2), ("b", "2024-01-22", None, 3), ("c", "2024-01-15", 5.0, 4), ("d", "2024-01-22", 5.0, 5)]
    frame = spark.createDataFrame([(k, day(d), s, t) for k, d, s, t in facts], "k string, d date, s double, t int")
    counted = frame.filter("k <> 'd'").unionByName(spark.createDataFrame([("other", day("2024-01-22"), None, 9)], frame.schema))
    out = by_key(mean_duration(frame, "d", "s", "t", WEEK, counted, by=["k"]), "k")
    assert {k: v["resolution_time"] for k, v in out.items()} == {"a": "60s", "b": "Immediate", "c": "N/A", "d": "N/A"}
    assert rows(mean_duration(frame.filter("k = 'd'"), "d", "s", "t", WEEK)) == [("5s",)]
    assert rows(mean_duration(frame.filter("false"), "d", "s", "t", WEEK)) == [("N/A",)]


def test_channel_counts(spark):
    calls = ["Answered", "Missed", "Voicemail Response", "Outbound", "Abandoned", None]
    facts = [("t", "1", "2024-01-22", 1, 1, "Voice", c) for c in calls]
    facts += [("t", "1", "2024-01-28", 1, 1, c, None) for c in ("Online", "Application", "Text", "Electronic Mail", "Fax", None)]
    facts += [("t", "1", "2024-01-29", 1, 1, "Text", None), ("t", "1", "2024-01-22", None, None, "Text", None), ("t", "1", "2024-01-22", None, 1, "Online", None)]
    facts += [("none", "2", "2024-01-10", 1, 1, "Text", None)]
    frame = spark.createDataFrame([(a, b, day(d), v, w, c, k) for a, b, d, v, w, c, k in facts], "a string, b string, d date, app int, v int, c string, k string")
    out = by_key(channel_counts(frame, "a", "b", "d", WEEK, "app", "v", "c", "k"), "a")
    names = ["All", "App", "Text Message", "Email", "Incoming Calls", "Outgoing Calls", "Connector"]
    assert [out["t"][n] for n in names] == [8, 2, 1, 1, 3, 1, "11"]
    assert [out["none"][n] for n in names] == [0, 0, 0, 0, 0, 0, "22"]


@pytest.mark.parametrize("limit", [1])
def test_small_lookup_reads_only_past_its_limit(spark, limit):
    assert small_lookup(spark.range(3), limit).count() == 3


def test_rejected_values(spark):
    upload = spark.createDataFrame([("1", "5"), ("01", "5.5"), (" 2", ""), (None, None), ("x", "absent"), ("x", "-7")], "student_id string, score string")
    got = sorted(rows(rejected_values(upload, "u", ["student_id"], ["score"])))
    assert got == [("u", "score", "", 1), ("u", "score", "5.5", 1), ("u", "score", "absent", 1), ("u", "student_id", " 2", 1), ("u", "student_id", "01", 1), ("u", "student_id", "x", 2)]
