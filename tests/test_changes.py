import datetime as dt
import random

import pytest
from helpers import by_key, rows
from pyspark.sql import functions as F

from recordkit.operators.changes import ColumnPair, compare_columns, last_change_dates, merge_change_dates, packed_code, stored_change_dates, where_changed
from recordkit.operators.updates import merge_files
from recordkit.sources.versions import Version, create_version, version


@pytest.mark.parametrize("n", [1, 8])
def test_packed_code_matches_brute_force(spark, partitions, n):
    partitions(n)
    pick = random.Random(6)
    values = [(f"P{pick.randrange(12)}" if pick.random() < 0.66 else "HOT", pick.choice(["primary", "other", None]), pick.choice(["A", "BC", "G", "", None]), pick.randint(1, 3)) for _ in range(250)]
    values.append(("EMPTY", None, None, 1))
    frame = spark.createDataFrame(values, "k string, role string, code string, copies int").repartition(5)
    out = by_key(packed_code(frame, ["k"], "code", F.col("role") == "primary", F.col("role") == "other", copies="copies"), "k")
    for key in {v[0] for v in values}:
        first = "".join(sorted(c * 1 for k, r, c, m in values if k == key and r == "primary" and c for _ in range(m)))
        others = "".join(sorted(c for k, r, c, m in values if k == key and r == "other" and c for _ in range(m)))
        assert out[key]["code"] == first.ljust(1, "Z")[:1] + others.ljust(9, "Z")[:9]
        assert len(out[key]["code"]) == 10
    assert out["EMPTY"]["code"] == "Z" * 10


def test_packed_code_keeps_ten_characters_of_many_codes(spark):
    codes = [("x", "other", c) for c in "MLKJIHGFEDCBA"] + [("x", "primary", "T"), ("x", "primary", "S")]
    frame = spark.createDataFrame(codes, "k string, role string, code string")
    assert rows(packed_code(frame, ["k"], "code", F.col("role") == "primary", F.col("role") == "other")) == [("x", "SABCDEFGHI")]


def test_last_change_dates(spark):
    def at(text):
        return dt.datetime.fromisoformat(text)

    log = [
        (1, 10, "UPDATE", "CUSTOM_821=5", at("2022-02-20T08:00:00")),
        (1, 10, "UPDATE", "CUSTOM_821=6,GRADE_ID=3", at("2022-03-01T23:59:59")),  # two items in one row
        (1, 10, "UPDATE", "GRADE_ID=3", at("2022-02-25T00:00:00")),
        (1, 10, "INSERT", "CUSTOM_821=7", at("2022-03-05T00:00:00")),  # no update
        (2, 10, "UPDATE", "CUSTOM_821=1", at("2022-02-17T23:59:59")),  # before the survey ended
        (3, 99, "UPDATE", "CUSTOM_821=1", at("2022-03-01T00:00:00")),  # unknown editor
        (4, 10, "UPDATE", "CUSTOMX821=1", at("2022-02-18T00:00:00")),  # underscore matches any character
        (5, 10, "UPDATE", "CUSTOM_821=1", at("2022-03-01T00:00:00")),  # not a subject
        (6, 10, "UPDATE", None, at("2022-03-01T00:00:00")),
    ]
    frame = spark.createDataFrame(log, "k int, user_id int, action string, after string, log_time timestamp")
    editors = spark.createDataFrame([(10,), (10,)], "user_id int")
    subjects = spark.createDataFrame([(1,), (1,), (2,), (3,), (4,), (6,)], "k int")
    out = last_change_dates(frame, "k", {"district": "%CUSTOM_821%", "grade": "%GRADE_ID%"}, dt.date(2022, 2, 18), editors, subjects)
    march = dt.date(2022, 3, 1)
    assert sorted(rows(out)) == [(1, march, march), (4, dt.date(2022, 2, 18), None)]


def test_compare_columns(spark):
    frame = spark.createDataFrame([("a", "b", "0", "10"), ("a", "a", "x", "10"), (None, "b", "0", "09"), ("q", "z", "y", "01")], "l string, r string, c string, g string")
    pairs = [
        ColumnPair("left", F.col("l"), "right", F.col("r"), "change"),
        ColumnPair("code", F.nullif("c", F.lit("0")), "sys", F.lit("x"), "code_change", F.col("c"), F.lit("x"), F.col("g").isin("09", "10")),
    ]
    out = frame.select(*compare_columns(pairs)).withColumn("date", where_changed("change", F.lit("20220301")))
    assert rows(out) == [
        ("a", "b", "Y", None, "x", "Y", "20220301"),
        ("a", "a", None, "x", "x", None, None),
        (None, "b", None, None, "x", "Y", None),
        ("q", "z", "Y", "y", "x", None, "20220301"),
    ]


def test_merged_change_dates_match_one_pass(spark, tmp_path, partitions):
    partitions(4)
    pick = random.Random(8)
    start = dt.datetime(2022, 3, 1)
    texts = ["CUSTOM_821=1", "GRADE_ID=2", "CUSTOM_821,GRADE_ID", "OTHER", None]
    log = [
        (0 if pick.random() < 0.34 else pick.choice([None, *range(1, 60)]), pick.choice([10, 99]), pick.choice(["UPDATE", "INSERT"]), pick.choice(texts), start + dt.timedelta(minutes=37 * i))
        for i in range(1_500)
    ]
    frame = spark.createDataFrame(log, "k int, user_id int, action string, after string, log_time timestamp").repartition(6)
    editors, subjects = spark.createDataFrame([(10,)], "user_id int"), spark.range(50).select(F.col("id").cast("int").alias("k"))
    patterns, root = {"district": "%CUSTOM_821%", "grade": "%GRADE_ID%"}, str(tmp_path / "state")
    for until in (start + dt.timedelta(days=d) for d in (3, 3, 20, 21, 21.5, 2, 90)):
        state = merge_change_dates(root, frame, "k", patterns, until, editors)
        assert state == version(spark, root)
    assert state.number == 5  # nothing is read twice
    for since in (dt.date(2022, 1, 1), dt.date(2022, 3, 22), dt.date(2022, 4, 7)):
        want = last_change_dates(frame, "k", patterns, since, editors, subjects)
        assert sorted(rows(stored_change_dates(state, "k", since, subjects))) == sorted(rows(want))
    with pytest.raises(ValueError, match="other items"):
        merge_change_dates(root, frame, "k", {"district": "%"}, dt.datetime(2023, 1, 1), editors)


def test_late_log_rows_are_read_again(spark, tmp_path):
    def log(*rows_):
        return spark.createDataFrame(list(rows_), "k int, user_id int, action string, after string, log_time timestamp")

    first, second = (1, 10, "UPDATE", "X", dt.datetime(2022, 3, 1)), (1, 10, "UPDATE", "X", dt.datetime(2022, 3, 2, 23))
    editors, root = spark.createDataFrame([(10,)], "user_id int"), str(tmp_path / "state")
    merge_change_dates(root, log(first), "k", {"x": "%X%"}, dt.datetime(2022, 3, 3), editors)
    arguments = ("k", {"x": "%X%"})
    assert rows(merge_change_dates(root, log(first, second), *arguments, dt.datetime(2022, 3, 4), editors).read(spark)) == [(1, dt.date(2022, 3, 1))]
    state = merge_change_dates(root, log(first, second), *arguments, dt.datetime(2022, 3, 5), editors, late=dt.timedelta(days=2))
    assert rows(state.read(spark)) == [(1, dt.date(2022, 3, 2))]


def test_only_the_new_part_of_the_log_is_read(spark, tmp_path):
    path, root = str(tmp_path / "log"), str(tmp_path / "state")
    spark.createDataFrame([(1, 10, "UPDATE", "X", dt.datetime(2022, 3, 1))], "k int, user_id int, action string, after string, log_time timestamp").write.parquet(path)
    editors = spark.createDataFrame([(10,)], "user_id int")
    merge_change_dates(root, spark.read.parquet(path), "k", {"x": "%X%"}, dt.datetime(2022, 3, 3), editors)
    held = {}
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")

    def remember(old, offered, *rest, **more):
        held["plan"] = offered._jdf.queryExecution().executedPlan().toString()
        return old

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr("recordkit.operators.changes.merge_files", remember)
        merge_change_dates(root, spark.read.parquet(path), "k", {"x": "%X%"}, dt.datetime(2022, 3, 9), editors)
    assert "GreaterThanOrEqual(log_time,2022-03-03" in held["plan"] and "LessThan(log_time,2022-03-09" in held["plan"]


def test_merged_files_without_a_change_stay(spark, tmp_path, partitions):
    partitions(8)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        old = create_version(spark.range(800).select("id", (F.col("id") % 7).alias("v")), str(tmp_path / "t"), by=["id"])
        offered = spark.createDataFrame([(5, 100), (790, 0), (900, 3), (None, 1)], "id long, v long")
        new = merge_files(old, offered, ["id"], {"v": F.greatest}, note="read")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(set(old.files) - set(new.files)) == 1 and new.note == version(spark, old.root).note == "read"
    want = {**{i: i % 7 for i in range(800)}, 5: 100, 900: 3, None: 1}
    assert {r["id"]: r["v"] for r in new.read(spark).collect()} == want
    again = merge_files(new, spark.createDataFrame([(None, 9)], "id long, v long"), ["id"], {"v": F.greatest})
    assert {r["id"]: r["v"] for r in again.read(spark).collect()} == {**want, None: 9}
    empty = Version(str(tmp_path / "e"), 0, old.schema, ())
    assert rows(merge_files(empty, offered.limit(0), ["id"], {"v": F.greatest}).read(spark)) == []
