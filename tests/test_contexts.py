"""Measures of several contexts from one pass, against the measures of one context each."""

from __future__ import annotations

import datetime as dt
import random
from decimal import Decimal

import pytest
from helpers import by_key
from pyspark.sql import functions as F

from recordkit.operators.tickets import GivenWeeks, TicketColumns, Week, channel_counts, daily_partials, mean_duration, measures_in_contexts, week_over_week

SCHEMA = "ticket_idx long, day date, id1 string, id2 string, value double, resolution double, seconds decimal(18,2), app_value long, channel string, call_type string"
WEEK = Week(dt.date(2024, 1, 31))
CHANNELS = ["All", "App", "Text Message", "Email", "Incoming Calls", "Outgoing Calls"]


def tickets(spark):
    pick = random.Random(3)
    rows = []
    for i in range(900):
        id1 = "hot" if pick.random() < 0.34 else pick.choice(["a", "b", "c", None])
        day = dt.date(2024, 1, 31) - dt.timedelta(days=pick.randint(-2, 25))
        if id1 == "c":
            day = dt.date(2023, 5, 1)  # no ticket in these weeks
        rows.append(
            (pick.choice([None, i]), day, id1, pick.choice(["x", "y", None]), pick.choice([None, 1.5]), pick.choice([None, 0.25, 2.0, 7.5]), pick.choice([None, 0, 90, 5000]), pick.choice([None, i]),
             pick.choice(["Online", "Application", "Text", "Electronic Mail", "Voice", "Fax", None]), pick.choice(["Answered", "Missed", "Outbound", "Abandoned", None]))
        )
    return spark.createDataFrame([(*r[:6], None if r[6] is None else Decimal(r[6]), *r[7:]) for r in rows], SCHEMA).repartition(4)


@pytest.mark.parametrize("given", [False, True])
def test_contexts_match_single_measures(spark, partitions, given):
    partitions(3)
    fact = tickets(spark)
    week = WEEK
    if given:
        days = fact.select("day").distinct().filter(F.dayofmonth("day") % 5 != 0)
        week = GivenWeeks(days.select(F.col("day").alias("date"), WEEK.offset(F.col("day")).alias("week_offset")))
    out = measures_in_contexts(daily_partials(fact, ["id1", "id2"]), [[], ["id1"], ["id2", "id1"]], week).collect()
    assert {r["context"] for r in out} == {"total", "id1", "id2+id1"}
    (total,) = [r for r in out if r["context"] == "total"]
    assert total["message"] == week_over_week(fact, "day", "resolution", week).first()[0]
    assert total["resolution_time"] == mean_duration(fact, "day", "seconds", "ticket_idx", week).first()[0]
    one = {r["id1"]: r for r in out if r["context"] == "id1"}
    messages, times = by_key(week_over_week(fact, "day", "resolution", week, ["id1"]), "id1"), by_key(mean_duration(fact, "day", "seconds", "ticket_idx", week, by=["id1"]), "id1")
    assert len(one) == 5 and {k: (r["message"], r["resolution_time"], r["id2"]) for k, r in one.items()} == {k: (messages[k]["message"], times[k]["resolution_time"], None) for k in messages}
    pairs = {(r["id1"], r["id2"]): [r[c] for c in CHANNELS] for r in out if r["context"] == "id2+id1"}
    single = channel_counts(fact, "id1", "id2", "day", week, "app_value", "value", "channel", "call_type").collect()
    assert pairs == {(r["id1"], r["id2"]): [r[c] for c in CHANNELS] for r in single}
    assert [total[c] for c in CHANNELS] == [sum(r[c] for r in single) for c in CHANNELS]


def test_contexts_scan_the_fact_once(spark, tmp_path):
    tickets(spark).write.parquet(str(tmp_path / "t"))
    fact = spark.read.parquet(str(tmp_path / "t"))
    plan = measures_in_contexts(daily_partials(fact, ["id1", "id2"]), [[], ["id1"], ["id1", "id2"]], WEEK)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Expand") == 1


def test_stored_partials_take_new_days(spark, tmp_path):
    fact, path = tickets(spark), str(tmp_path / "partials")
    for part in (F.col("day") < "2024-01-20", F.col("day") >= "2024-01-20"):
        daily_partials(fact.filter(part), ["id1", "id2"]).write.mode("append").parquet(path)
    contexts = [["id1"], ["id1", "id2"], []]
    a, b = (sorted(measures_in_contexts(p, contexts, WEEK).collect(), key=str) for p in (spark.read.parquet(path), daily_partials(fact, ["id1", "id2"])))
    assert a == b


def test_no_tickets(spark):
    assert measures_in_contexts(daily_partials(tickets(spark).limit(0), ["id1"], TicketColumns(counted="app_value")), [[], ["id1"]], WEEK).collect() == []
