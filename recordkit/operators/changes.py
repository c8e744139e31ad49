"""Packed codes, dates of last change and column-by-column comparison."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from recordkit.functions.rules import change_flag
from recordkit.functions.text import join_text
from recordkit.operators.updates import merge_files
from recordkit.sources.versions import Version, create_version, version


def packed_code(
    codes: DataFrame, key: list[str], code: str, primary: Column, other: Column, width: int = 10, pad: str = "Z", copies: str | None = None
) -> DataFrame:
    """One primary character plus the sorted other codes, padded to ``width`` characters.

    ``primary`` and ``other`` say which role a row has (never both); ``copies`` names a column
    that says how often a row counts. Only ``width - 1`` characters of the other codes survive,
    and every non-empty code has at least one, so the first ``width - 1`` different codes per key
    and role are all that is gathered: equal codes are counted first, and the limit per key
    applies before the shuffle. A key without any code keeps its row of padding.
    """
    room = width - 1
    text = F.nullif(F.col(code), F.lit(""))
    role = F.when(text.isNull(), None).when(primary, "primary").when(other, "other")
    weight = F.col(copies) if copies else F.lit(1)
    counted = (
        codes.select(*key, role.alias("_role"), text.alias("_text"), weight.alias("_w"))
        .withColumn("_text", F.when(F.col("_role").isNotNull(), F.col("_text")))
        .groupBy(*key, "_role", "_text")
        .agg(F.sum("_w").alias("_n"))
    )
    in_order = Window.partitionBy(*key, "_role").orderBy("_text")
    first_codes = counted.withColumn("_rn", F.row_number().over(in_order)).filter(F.col("_rn") <= room)
    repeated = F.expr(f"repeat(_text, cast(least(_n, {room}) as int))")
    is_primary, is_other = F.col("_role") == "primary", F.col("_role") == "other"
    gathered = first_codes.groupBy(*key).agg(
        F.min(F.when(is_primary, F.col("_text"))).alias("_head"),
        F.array_sort(F.collect_list(F.when(is_other, F.struct("_rn", repeated.alias("_text"))))).alias("_tail"),
    )
    head = F.rpad(F.coalesce("_head", F.lit("")), 1, pad)
    tail = F.rpad(F.array_join(F.transform("_tail", lambda c: c["_text"]), ""), room, pad)
    return gathered.select(*key, join_text(head, tail).alias("code"))


def last_change_dates(
    log: DataFrame, key: str, patterns: dict[str, str], since: dt.date, editors: DataFrame, subjects: DataFrame | None = None
) -> DataFrame:
    """Per key: the date of the last ``UPDATE`` whose ``after`` text is LIKE each pattern.

    ``patterns`` maps result column -> LIKE pattern (an underscore matches any character). One
    scan serves all fields, each date is a conditional maximum that is combined before the
    shuffle, and ``editors(user_id)`` / ``subjects(key)`` only test existence; they are reduced to
    different keys first, because a semi join cannot split a hot key of its right side. Keys
    without any matching change have no row.
    """
    # Compared as a point in time, not as a day, so that the condition reaches the scan.
    latest = _newest_changes(log.filter(F.col("log_time") >= F.lit(since).cast("date")), key, patterns, editors)
    return latest if subjects is None else latest.join(subjects.select(key).distinct(), key, "left_semi")


def _newest_changes(log: DataFrame, key: str, patterns: dict[str, str], editors: DataFrame) -> DataFrame:
    matches = {name: F.col("after").like(pattern) for name, pattern in patterns.items()}
    wanted = log.filter((F.col("action") == "UPDATE") & reduce(lambda a, b: a | b, matches.values()))
    wanted = wanted.join(editors.select("user_id").distinct(), "user_id", "left_semi")
    day = F.col("log_time").cast("date")
    return wanted.groupBy(key).agg(*[F.max(F.when(m, day)).alias(name) for name, m in matches.items()])


def merge_change_dates(
    root: str, log: DataFrame, key: str, patterns: dict[str, str], until: dt.datetime, editors: DataFrame, late: dt.timedelta = dt.timedelta(0)
) -> Version:
    """Bring the stored newest change per key and item below ``root`` up to ``until`` (exclusive), and give its new version.

    The stored table has one row per key; its version notes up to where the log has been read, and only log rows from
    there on are read now (a range that reaches the scan). Their newest dates are maxima, so a log row that is read twice changes nothing:
    ``late`` reads that much again for rows that come late, and a run that fails before its version is published is repeated whole. Files of
    the stored table without a changed key stay. An editor counts if known when the row is read. Patterns are those of the first run.
    """
    spark = log.sparkSession
    end = F.col("log_time") < F.lit(until.isoformat(" ")).cast(log.schema["log_time"].dataType)
    try:
        old = version(spark, root)
    except FileNotFoundError:
        return create_version(_newest_changes(log.filter(end), key, patterns, editors), root, by=[key], note=until.isoformat())
    if old.schema.names != [key, *patterns]:
        raise ValueError(f"{root} holds other items: {old.schema.names}")
    read_to = dt.datetime.fromisoformat(old.note)
    if until <= read_to:
        return old
    begin = F.col("log_time") >= F.lit((read_to - late).isoformat(" ")).cast(log.schema["log_time"].dataType)
    newest = _newest_changes(log.filter(begin & end), key, patterns, editors)
    return merge_files(old, newest, [key], {name: F.greatest for name in patterns}, note=until.isoformat())


def stored_change_dates(state: Version, key: str, since: dt.date, subjects: DataFrame) -> DataFrame:
    """``last_change_dates`` since a day, from the stored newest changes; the log is not read."""
    day = F.lit(since).cast("date")
    items = [c for c in state.schema.names if c != key]
    dates = state.read(subjects.sparkSession).select(key, *[F.when(F.col(c) >= day, F.col(c)).alias(c) for c in items])
    return dates.filter(F.coalesce(*items).isNotNull()).join(subjects.select(key).distinct(), key, "left_semi")


@dataclass(frozen=True)
class ColumnPair:
    """A compared item: the shown values and, where they differ from these, the compared ones."""

    left_name: str
    left: Column
    right_name: str
    right: Column
    flag_name: str
    compare_left: Column | None = None
    compare_right: Column | None = None
    only_if: Column | None = None


def compare_columns(pairs: list[ColumnPair]) -> list[Column]:
    """For each pair: left value, right value and a ``Y`` flag where both are known and differ."""
    out = []
    for p in pairs:
        left = p.left if p.compare_left is None else p.compare_left
        right = p.right if p.compare_right is None else p.compare_right
        changed = change_flag(left, right)
        if p.only_if is not None:
            changed = F.when(p.only_if, changed)
        out += [p.left.alias(p.left_name), p.right.alias(p.right_name), changed.alias(p.flag_name)]
    return out


def where_changed(flag_name: str, value: Column) -> Column:
    """The value only where the flag is ``Y``."""
    return F.when(F.col(flag_name) == "Y", value)
