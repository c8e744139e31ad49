"""Relative weeks, blank handling and the two ticket sentences."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from recordkit.functions.text import join_text, short_number

# The sentences a reader sees.
NO_COMPARISON = "No comparison can be done due to one of the past two weeks having no data."
NO_RESOLUTIONS = "There have been no resolution times recorded in the past two weeks."
NOT_PULLED = "[DATA UNABLE TO BE PULLED]"
LEAD_IN = "Your time to resolution last week "
PERCENT_OPEN = "<b><span style='color:#333333'>"
PERCENT_CLOSE = "%</span></b>"
LEAD_OUT = " compared to the prior week."
NO_TICKETS = "N/A"
IMMEDIATE = "Immediate"
UNEXPECTED = "Yikes"

WEEKDAYS = ("monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday")


def _week_number(day: Column, week_start: str) -> Column:
    # Day 0 (1970-01-01) is a Thursday, so +3 counts from a Monday.
    return F.floor((F.unix_date(day) + F.lit(3 - WEEKDAYS.index(week_start))) / 7)


def week_offset(day: Column, as_of: dt.date, week_start: str = "monday") -> Column:
    """Whole weeks between the week of ``as_of`` (0) and the week of ``day`` (-1 = last week)."""
    current = _week_number(F.lit(as_of).cast("date"), week_start)
    return (_week_number(day.cast("date"), week_start) - current).cast("int")


def in_weeks(day: Column, as_of: dt.date, first: int, last: int, week_start: str = "monday") -> Column:
    """Day or time within the weeks ``first`` to ``last`` relative to ``as_of``, as a range on the
    column itself, so that files and partitions outside it are not read."""
    current = as_of - dt.timedelta(days=(as_of.weekday() - WEEKDAYS.index(week_start)) % 7)
    begin, end = (current + dt.timedelta(weeks=n) for n in (first, last + 1))
    return (day >= F.lit(begin).cast("date")) & (day < F.lit(end).cast("date"))


def is_blank(col: Column) -> Column:
    """Dashboard blank: a missing number equals zero."""
    return F.coalesce(col, F.lit(0)) == 0


def zero_if_blank(col: Column) -> Column:
    return F.coalesce(col, F.lit(0))


def week_over_week_text(last: Column, prior: Column, strict_blank: bool = False) -> Column:
    """Sentence comparing the mean of last week with the mean of the week before.

    A blank mean counts as zero, so "both weeks empty" is already caught by the first test;
    ``strict_blank`` asks the both-empty question first.
    """
    p, q = zero_if_blank(last), zero_if_blank(prior)
    change = F.abs(F.try_divide(p - q, F.abs(q)) * 100)

    def sentence(direction: str) -> Column:
        return join_text(
            F.lit(LEAD_IN + direction + " " + PERCENT_OPEN),
            short_number(change),
            F.lit(PERCENT_CLOSE + LEAD_OUT),
        )

    one_empty, both_empty = (p == 0) | (q == 0), (p == 0) & (q == 0)
    text = F.when(both_empty, NO_RESOLUTIONS).when(one_empty, NO_COMPARISON) if strict_blank else F.when(one_empty, NO_COMPARISON)
    return text.when(p > q, sentence("declined")).when(p < q, sentence("improved")).otherwise(NOT_PULLED)


def with_duration_text(df: DataFrame, seconds: str, tickets: str, name: str, exact: bool = False) -> DataFrame:
    """Add seconds as ``1d 2h 3m 4s``, leaving out leading units that are zero.

    The default keeps the displayed rule: each unit is taken from the rest of the one above in
    floating point and seconds are rounded last, so 119.7 shows ``1m 60s``. ``exact`` rounds the
    total first and splits it in whole numbers. Every unit is a column of its own, because one
    nested expression would compute the upper units again in each lower one.
    """
    given = F.col(seconds)
    if exact:
        df = df.withColumn("_total", F.round(given.cast("decimal(38,9)"), 0).cast("bigint"))
        df = df.withColumns({"_h": F.floor(F.col("_total") / 3600), "_m": F.floor(F.col("_total") % 3600 / 60), "_s": F.col("_total") % 60})
    else:
        df = df.withColumn("_hours", given.cast("double") / 3600)
        df = df.withColumn("_h", _toward_zero(F.col("_hours")))
        df = df.withColumn("_minutes", (F.col("_hours") - F.col("_h")) * 60)
        df = df.withColumn("_m", _toward_zero(F.col("_minutes")))
        df = df.withColumn("_s", F.round((F.col("_minutes") - F.col("_m")) * 60, 0).cast("bigint"))
    df = df.withColumn("_d", _toward_zero(F.col("_h") / 24))
    hours, minutes, days = F.col("_h"), F.col("_m"), F.col("_d")
    hours_of_day = F.round((hours / 24 - days) * 24, 0).cast("bigint")

    def unit(value: Column, letter: str) -> Column:
        return F.concat(value.cast("string"), F.lit(letter))

    spelled = F.concat_ws(
        " ",
        F.when(hours >= 24, unit(days, "d")),
        F.when(hours >= 24, unit(hours_of_day, "h")).when(hours >= 1, unit(hours, "h")),
        F.when((hours >= 1) | (minutes >= 1), unit(minutes, "m")),
        unit(F.col("_s"), "s"),
    )
    text = (
        F.when(is_blank(F.col(tickets)), NO_TICKETS)
        .when(is_blank(given), IMMEDIATE)
        .when(hours.isNotNull(), spelled)
        .otherwise(UNEXPECTED)
    )
    return df.withColumn(name, text).drop("_total", "_hours", "_h", "_minutes", "_m", "_s", "_d")


def _toward_zero(col: Column) -> Column:
    return col.cast("bigint")
