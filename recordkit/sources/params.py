"""Report parameters as filter conditions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, functions as F


def optional_equals(col: Column, value: object | None) -> Column:
    """``col = value``, or no restriction when the value is not given."""
    return F.lit(True) if value is None else col == F.lit(value)


def value_or_all(col: Column, choice: str | Iterable[str], everything: Iterable[str]) -> Column:
    """Rows matching the chosen value(s); ``ALL`` stands for every value of ``everything``."""
    chosen = [choice] if isinstance(choice, str) else list(choice)
    return col.isin(*(everything if chosen == ["ALL"] else chosen))
