"""Ticket measures: conditional means and counts per week."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from recordkit.functions.text import join_text
from recordkit.functions.weeks import in_weeks, week_offset, week_over_week_text, with_duration_text

# Channel and call names and the columns they feed.
APP_CHANNELS = ("Online", "Application")
TEXT_CHANNEL = "Text"
MAIL_CHANNEL = "Electronic Mail"
VOICE_CHANNEL = "Voice"
INCOMING_CALLS = ("Answered", "Missed", "Voicemail Response")
OUTGOING_CALL = "Outbound"


@dataclass(frozen=True)
class Week:
    """The day the report is for, and the first day of its weeks."""

    as_of: dt.date
    starts_on: str = "monday"

    def offset(self, day: Column) -> Column:
        return week_offset(day, self.as_of, self.starts_on)

    def holds(self, day: Column, first: int, last: int) -> Column:
        return in_weeks(day, self.as_of, first, last, self.starts_on)

    def attach(self, fact: DataFrame, day: str, span: tuple[int, int] | None = None) -> DataFrame:
        """The fact with ``_offset``, the week of each row; with ``span`` only rows of these weeks, read by a range of days."""
        rows = fact.filter(self.holds(F.col(day), *span)) if span else fact
        return rows.withColumn("_offset", self.offset(F.col(day)))


@dataclass(frozen=True)
class GivenWeeks:
    """Weeks of a calendar table with one row per day: its ``date`` and its ``week_offset`` (-1 = last week)."""

    calendar: DataFrame
    date: str = "date"
    offset: str = "week_offset"

    def attach(self, fact: DataFrame, day: str, span: tuple[int, int] | None = None) -> DataFrame:
        """As ``Week.attach``. Days that the calendar lacks have no week; the wanted weeks' first and last day become
        a range on the fact's own column, so a calendar prunes what is read as well."""
        days = self.calendar.select(F.col(self.date).cast("date").alias("_date"), F.col(self.offset).alias("_offset"))
        if span:
            days = days.filter(F.col("_offset").between(*span))
            edge = days.agg(F.min("_date").alias("first"), F.date_add(F.max("_date"), 1).alias("end")).first()
            fact = fact.filter((F.col(day) >= F.lit(edge["first"]).cast("date")) & (F.col(day) < F.lit(edge["end"]).cast("date")))
        return fact.join(days, F.col(day).cast("date") == F.col("_date"), "inner" if span else "left").drop("_date")


Weeks = Week | GivenWeeks


def related(fact: DataFrame, sides: dict[str, DataFrame]) -> DataFrame:
    """The fact with the columns of its related tables, each joined on the key it is named by.

    Related tables have one row per key. A fact row without a related one keeps NULL; a related row that no fact row
    names (a call without a ticket) belongs to no group of the fact and counts nowhere.
    """
    for key, side in sides.items():
        fact = fact.join(side, key, "left")
    return fact


def calendar(days: DataFrame, day: str, week: Week) -> DataFrame:
    """The different days of a fact with their week offset: one row per day."""
    return days.select(F.col(day).cast("date").alias("date")).distinct().withColumn(
        "week_offset", week.offset(F.col("date"))
    )


def mean_where(value: Column, condition: Column) -> Column:
    """Mean over the rows where the condition holds, of plain numbers of any size. Integers and decimals add up exactly;
    the last digits of floating-point sums depend on the order, and the texts show two places."""
    wanted = F.when(condition, value)
    return F.try_divide(F.sum(wanted).cast("double"), F.count(wanted).cast("double"))


def count_where(value: Column, condition: Column) -> Column:
    """Number of non-NULL values where the condition holds; 0 when there are none."""
    return F.count(F.when(condition, value))


def week_over_week(fact: DataFrame, day: str, value: str, week: Weeks, by: list[str] | None = None, strict_blank: bool = False) -> DataFrame:
    """Sentence comparing the means of the last two weeks; one row, or one per ``by`` group.

    Without groups only the two weeks are read. With groups all rows are, because a group without
    tickets in these weeks has its sentence too.
    """
    offset = F.col("_offset")
    rows = week.attach(fact, day, None if by else (-2, -1))
    means = rows.groupBy(*(by or [])).agg(
        mean_where(F.col(value), offset == -1).alias("last_week"),
        mean_where(F.col(value), offset == -2).alias("prior_week"),
    )
    text = week_over_week_text(F.col("last_week"), F.col("prior_week"), strict_blank)
    return means.select(*(by or []), text.alias("message"))


def mean_duration(
    fact: DataFrame, day: str, seconds: str, ticket: str, week: Weeks, counted: DataFrame | None = None, by: list[str] | None = None, exact: bool = False
) -> DataFrame:
    """Mean duration of last week as text. The ticket number is 0 if ``fact`` has none last week,
    else the one of ``counted`` (by default the same table). Without groups only last week is read."""
    groups = by or []
    none = F.lit(None)
    rows = fact.select(*groups, F.col(day).alias("_day"), F.col(seconds).alias("_seconds"), F.col(ticket).alias("_own"), none.alias("_other"), F.lit(1).alias("_fact"))
    if counted is not None:
        rows = rows.unionByName(
            counted.select(*groups, F.col(day).alias("_day"), none.alias("_seconds"), none.alias("_own"), F.col(ticket).alias("_other"), none.alias("_fact"))
        )
    rows = week.attach(rows, "_day", None if groups else (-1, -1))
    last_week = F.col("_offset") == -1
    means = rows.groupBy(*groups).agg(
        mean_where(F.col("_seconds"), last_week).alias("_mean"),
        count_where(F.col("_own"), last_week).alias("_own"),
        count_where(F.col("_other"), last_week).alias("_other"),
        F.count("_fact").alias("_rows"),
    )
    if groups:
        means = means.filter("_rows > 0")
    tickets = F.col("_own") if counted is None else F.when(F.col("_own") == 0, 0).otherwise(F.col("_other"))
    shown = with_duration_text(means.withColumn("_tickets", tickets), "_mean", "_tickets", "resolution_time", exact)
    return shown.select(*groups, "resolution_time")


@dataclass(frozen=True)
class TicketColumns:
    """Names of the fact's columns that the measures read; ``counted`` is the ticket number that is looked at where ``ticket`` has any."""

    day: str = "day"
    resolution: str = "resolution"
    seconds: str = "seconds"
    ticket: str = "ticket_idx"
    counted: str = "ticket_idx"
    app_value: str = "app_value"
    value: str = "value"
    channel: str = "channel"
    call_type: str = "call_type"


def _channel_conditions(channel: str, call_type: str) -> dict[str, Column]:
    name, call = F.col(channel), F.col(call_type)
    voice = name == VOICE_CHANNEL
    return {
        "App": name.isin(*APP_CHANNELS),
        "Text Message": name == TEXT_CHANNEL,
        "Email": name == MAIL_CHANNEL,
        "Incoming Calls": voice & call.isin(*INCOMING_CALLS),
        "Outgoing Calls": voice & (call == OUTGOING_CALL),
    }


def daily_partials(fact: DataFrame, ids: list[str], c: TicketColumns = TicketColumns()) -> DataFrame:
    """Sums and counts per day and ids, from which all measures of any weeks and any of the ids add up. A stored table of them can take new days in
    place of reading the fact again."""
    counts = {"own": c.ticket, "other": c.counted, "resolution_n": c.resolution, "seconds_n": c.seconds}
    sums = {"resolution_sum": c.resolution, "seconds_sum": c.seconds}
    channels = {n: count_where(F.col(c.app_value if n == "App" else c.value), k) for n, k in _channel_conditions(c.channel, c.call_type).items()}
    return fact.groupBy(F.col(c.day).cast("date").alias("day"), *ids).agg(
        *[F.sum(v).alias(n) for n, v in sums.items()], *[F.count(v).alias(n) for n, v in counts.items()], *[v.alias(n) for n, v in channels.items()]
    )


def measures_in_contexts(partials: DataFrame, contexts: list[list[str]], week: Weeks, strict_blank: bool = False, exact: bool = False) -> DataFrame:
    """The week-over-week sentence, last week's mean duration as text and last week's tickets per channel for each group of each context.

    ``contexts`` lists the ids that each groups by, none for the total; a group's row names its context and has NULL for other ids. All of them
    come from one pass over ``daily_partials`` by grouping sets, and thus from one scan of the fact. Weeks meet the partials, which are
    fewer than the fact's rows. Groups without tickets in these weeks have their row too; a fact without rows has none, nor a total.
    """
    ids = list(dict.fromkeys(i for context in contexts for i in context))
    rows = week.attach(partials, "day")
    channels = list(_channel_conditions("day", "day"))

    def total(name: str, offset: int) -> Column:
        return F.sum(F.when(F.col("_offset") == offset, F.col(f"`{name}`")))

    def mean(name: str, offset: int) -> Column:
        return F.try_divide(total(f"{name}_sum", offset).cast("double"), total(f"{name}_n", offset))

    sets = [[F.col(i) for i in context] for context in contexts]
    found = rows.groupingSets(sets, *ids).agg(
        F.grouping_id(*ids).alias("_set"),
        mean("resolution", -1).alias("_last"),
        mean("resolution", -2).alias("_prior"),
        mean("seconds", -1).alias("_mean"),
        *[F.coalesce(total(n, -1), F.lit(0)).alias(f"_{n}") for n in ("own", "other")],
        *[F.coalesce(total(n, -1), F.lit(0)).alias(n) for n in channels],
    )
    # The n-th id from the right sets the n-th bit where a context leaves it out.
    names = {sum(1 << (len(ids) - 1 - n) for n, i in enumerate(ids) if i not in context): "+".join(context) or "total" for context in contexts}
    tickets = F.when(F.col("_own") == 0, 0).otherwise(F.col("_other"))
    shown = with_duration_text(found.withColumn("_tickets", tickets), "_mean", "_tickets", "resolution_time", exact)
    context = F.element_at(F.create_map(*[F.lit(x) for pair in names.items() for x in pair]), F.col("_set").cast("int"))
    return shown.select(
        context.alias("context"),
        *ids,
        week_over_week_text(F.col("_last"), F.col("_prior"), strict_blank).alias("message"),
        "resolution_time",
        sum((F.col(f"`{n}`") for n in channels), F.lit(0).cast("bigint")).alias("All"),
        *[F.col(f"`{n}`") for n in channels],
    )


def channel_counts(
    fact: DataFrame, first_id: str, second_id: str, day: str, week: Weeks, app_value: str, value: str, channel: str, call_type: str
) -> DataFrame:
    """Tickets of last week per channel for every pair of ids, zeros included."""
    last_week = F.col("_offset") == -1
    conditions = _channel_conditions(channel, call_type)
    counts = {n: count_where(F.col(app_value if n == "App" else value), last_week & k) for n, k in conditions.items()}
    grouped = week.attach(fact, day).groupBy(first_id, second_id).agg(*[c.alias(n) for n, c in counts.items()])
    total = sum((F.col(f"`{n}`") for n in counts), F.lit(0).cast("bigint"))
    second = F.col(second_id).cast("string")
    return grouped.select(
        first_id, second_id, total.alias("All"), *[F.col(f"`{n}`") for n in counts], join_text(second, second).alias("Connector")
    )
