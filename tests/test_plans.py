"""The physical plans hold the properties the operators promise."""

from __future__ import annotations

import datetime as dt
import re
from functools import partial

import pytest
from pyspark.sql import functions as F

from recordkit.operators import joins, keys, reshape
from recordkit.operators.changes import last_change_dates
from recordkit.operators.joins import left_fan
from recordkit.operators.measures import attendance_rate
from recordkit.operators.tickets import Week, week_over_week
from recordkit.operators.updates import keyed_update
from recordkit.plans.answer_sheet import answer_rows
from recordkit.plans.student_extract import ExtractRun, student_extract
from recordkit.queries import reports, steps  # noqa: F401  (register their queries)
from recordkit.queries.registry import QUERIES
from recordkit.queries.sis import model
from recordkit.queries.tables import Tables
from recordkit.sources import tables

GIVEN = "/root/testdata/sf0.001"
UNWANTED = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas")


def planned(df) -> str:
    df.sparkSession.conf.set("spark.sql.maxMetadataStringLength", "2000")
    return df._jdf.queryExecution().executedPlan().toString()


def finished(df) -> str:
    df.collect()
    return planned(df).split("== Initial Plan ==")[0]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_and_no_pairwise_joins(spark, name):
    plan = planned(QUERIES[name](spark, GIVEN))
    assert not [u for u in UNWANTED if u in plan]


def test_the_audit_log_is_read_once_with_its_filters(spark):
    t = Tables(spark, GIVEN)
    log = t.events.select("user_id", F.col("event_type").alias("action"), F.col("props").alias("after"), F.col("ts").alias("log_time"), F.col("event_id").alias("k"))
    editors = t.supplier.select(F.col("s_suppkey").alias("user_id"))
    out = last_change_dates(log, "k", {f"p{i}": f"%{i}%" for i in range(6)}, dt.date(2024, 1, 10), editors)
    plan = planned(out)
    assert plan.count("events.parquet") == 1
    assert re.search(r"PushedFilters: \[[^]]*GreaterThanOrEqual\(ts,2024-01-10", plan)
    assert "value" not in re.search(r"ReadSchema: (struct<[^\n]*user_id[^\n]*)", plan).group(1)


def test_a_week_measure_reads_two_weeks_only(spark):
    plan = planned(week_over_week(Tables(spark, GIVEN).events, "ts", "value", Week(dt.date(2024, 1, 31))))
    assert "GreaterThanOrEqual(ts,2024-01-15" in plan and "LessThan(ts,2024-01-29" in plan


def test_aggregates_are_combined_before_the_shuffle(spark):
    lines = Tables(spark, GIVEN).lineitem
    plan = planned(attendance_rate(lines, ["l_suppkey"], "l_linenumber"))
    assert plan.index("Exchange hashpartitioning(l_suppkey") < plan.index("partial_sum")  # printed from the last step down
    assert "ReadSchema: struct<l_suppkey:bigint,l_linenumber:int>" in plan


def test_the_spine_of_a_fan_is_shuffled_once(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        t = Tables(spark, GIVEN)
        sides = [t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.max("o_orderkey").alias(f"m{i}"), F.count("o_orderpriority").alias(f"n{i}")) for i in range(3)]
        plan = planned(left_fan(t.customer.select("c_custkey"), sides, ["c_custkey"]))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plan.count("SortMergeJoin") == 3 and plan.count("Exchange hashpartitioning") == 4


def test_a_hot_join_key_is_split(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100000",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.shuffle.partitions": "8",
    }
    before = {k: spark.conf.get(k) for k in settings if k != "spark.sql.adaptive.autoBroadcastJoinThreshold"}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        rows = spark.range(0, 300_000, 1, 12)
        target = rows.select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"), F.col("id").alias("v"))
        source = rows.select(F.col("id").alias("s"), (F.col("id") + 1).alias("w"))
        result = keyed_update(target, source, {"k": "s"}, "v", "w").table
        assert "SortMergeJoin(skew=true)" in finished(result)
        assert result.filter("k = 7 AND v = 8").count() == 100_001 and result.count() == 300_000
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("broadcast", ["10m", "-1"])
def test_extract_keeps_rows_of_its_students_first(spark, broadcast):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        sis = model(spark, GIVEN)
        run = ExtractRun("label", (1, 2))
        logical = student_extract(sis, run)._jdf.queryExecution().optimizedPlan().toString()
        assert logical.count("LeftSemi") >= 3  # days, referrals, administrations
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("key_rows", [100_000, 0])
def test_answer_sheet_is_ordered_by_student(spark, partitions, monkeypatch, key_rows):
    monkeypatch.setattr(reshape, "is_small", partial(joins.is_small, rows=key_rows))
    partitions(6)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sheet = answer_rows(model(spark, GIVEN))
        placed = sheet.withColumn("part", F.spark_partition_id()).select("student_id", "course", "school_id", "part").collect()
        plan = planned(sheet)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    students = [(r["student_id"], r["course"], r["school_id"]) for r in placed]
    assert students == sorted(students) and len(set(students)) > 1 and len({r["part"] for r in placed}) > 1
    # Printed from the last step down: the sheet goes through the range exchange before it is unpivoted.
    assert (plan.index("Expand") < plan.index("Exchange rangepartitioning")) == (key_rows > 0)


def test_answer_sheet_stores_no_product(spark, monkeypatch):
    written = []
    monkeypatch.setattr(tables, "stage", lambda df, *rest: written.append(df) or df)
    monkeypatch.setattr(keys, "stage", tables.stage)
    answer_rows(model(spark, GIVEN))
    assert written == []
