"""Membership of an assessment window."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, functions as F


@dataclass(frozen=True)
class AssessmentWindow:
    """First day of the year's courses, and first and last day of the assessment."""

    year_start: dt.date
    opens: dt.date
    closes: dt.date


def _day(value: dt.date) -> Column:
    return F.lit(value).cast("date")


def course_member(w: AssessmentWindow, start: Column, end: Column, newest_by_end: Column) -> Column:
    """In the course during the window: still open, closed inside the window, or started during
    the year, closed and the newest of the student's schedule rows by end date."""
    started = start <= _day(w.opens)
    running = end.isNull() & started
    closed_inside = end.between(_day(w.opens), _day(w.closes)) & started
    newest = start.between(_day(w.year_start), _day(w.opens)) & end.isNotNull() & newest_by_end
    return running | closed_inside | newest


def school_member(w: AssessmentWindow, start: Column, end: Column, newest_by_start: Column, newest_by_end: Column) -> Column:
    """In the school during the window: as for the course, but a closing inside the window counts
    only for the newest row by start date, and a late start does not exclude the newest closed row."""
    started = start <= _day(w.opens)
    running = end.isNull() & started
    closed_inside = end.between(_day(w.opens), _day(w.closes)) & started & newest_by_start
    newest = (start >= _day(w.year_start)) & end.isNotNull() & newest_by_end
    return running | closed_inside | newest
