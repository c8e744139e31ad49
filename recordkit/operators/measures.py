"""Per-key rates, distinct counts and newest scores."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from recordkit.functions.rules import flag, percent, presence_flag
from recordkit.operators.keys import newest_place


def attendance_rate(days: DataFrame, key: list[str], value: str) -> DataFrame:
    """Per key: sum and non-NULL count of a 0/1 value. Both are combined before the shuffle."""
    return days.groupBy(*key).agg(
        F.sum(value).cast("decimal(18,4)").alias("present"),
        F.count(value).alias("total"),
    )


def rate_columns(present: Column, total: Column, below: int) -> dict[str, Column]:
    """``rate`` in percent and ``below_threshold`` (NULL where there is no rate)."""
    rate = percent(present, total)
    return {"rate": rate, "below_threshold": flag(rate < below, rate)}


def distinct_events(events: DataFrame, key: list[str], event: str) -> DataFrame:
    """Exact number of different events per key; Spark deduplicates (key, event) pairs by a
    shuffle on both columns, so one busy key is spread over many tasks."""
    return events.groupBy(*key).agg(F.count_distinct(event).alias("events"))


def with_presence(df: DataFrame, column: str, name: str) -> DataFrame:
    return df.withColumn(name, presence_flag(F.col(column)))


@dataclass(frozen=True)
class ScoreKind:
    """Scores wanted: a condition on ``test`` and ``part`` titles, and a score type or any."""

    titles: Column
    score_type: str | None = None


def latest_scores(
    administrations: DataFrame,
    tests: DataFrame,
    parts: DataFrame,
    scores: DataFrame,
    score_types: DataFrame,
    kinds: dict[str, ScoreKind],
    students: DataFrame | None = None,
) -> DataFrame:
    """One row per student with, per kind, the ``test``, ``score``, ``test_code`` and
    ``administration_date`` of the newest administration as a struct column (NULL without any).

    All kinds come from one pass over scores and administrations: the test titles are filtered
    before they meet the scores, and the newest row per student and kind is a minimum that is
    combined before the only shuffle by student. With ``students`` (column ``student_id``), only their administrations
    meet the scores.
    """
    any_kind = reduce(lambda a, b: a | b, [k.titles for k in kinds.values()])
    wanted = (
        tests.select(F.col("id").alias("test_id"), F.col("title").alias("test"))
        .join(parts.select(F.col("id").alias("part_id"), "test_id", F.col("title").alias("part")), "test_id")
        .filter(any_kind)
    )
    types = score_types.select(F.col("id").alias("score_type_id"), F.col("short_name").alias("score_type"))
    taken = administrations.select(F.col("id").alias("administration_id"), "student_id", "test_id", "administration_date")
    if students is not None:
        taken = taken.join(students, "student_id", "left_semi")
    rows = (
        scores.select("administration_id", "part_id", "test_id", "score_type_id", "score", "test_code")
        .join(wanted, ["test_id", "part_id"])
        .join(types, "score_type_id", "left")
        .join(taken, ["administration_id", "test_id"])
    )
    place = newest_place("administration_date", ["administration_id", "test", "part_id", "score", "test_code", "administration_date"])
    newest = {}
    for name, kind in kinds.items():
        typed = kind.titles if kind.score_type is None else kind.titles & (F.col("score_type") == kind.score_type)
        newest[name] = F.min(F.when(typed, place))
    shown = ("test", "score", "test_code", "administration_date")
    picked = rows.groupBy("student_id").agg(*[c.alias(name) for name, c in newest.items()])
    return picked.select(
        "student_id",
        *[F.when(F.col(n).isNotNull(), F.struct(*[F.col(n)[c].alias(c) for c in shown])).alias(n) for n in kinds],
    )
