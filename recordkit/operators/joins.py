"""Join shapes used by several reports."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


LOOKUP_ROWS, LOOKUP_BYTES = 100_000, 32 << 20


def is_small(lookup: DataFrame, rows: int = LOOKUP_ROWS, size: int = LOOKUP_BYTES) -> bool:
    """True if a table has at most ``rows`` rows, and ``size`` bytes of values as text; no more than ``rows + 1`` rows are read."""
    text = F.concat_ws("", *[F.col(f"`{c}`").cast("string") for c in lookup.columns])
    found = lookup.limit(rows + 1).agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(F.octet_length(text)), F.lit(0)).alias("size")).first()
    return found["rows"] <= rows and found["size"] <= size


def small_lookup(lookup: DataFrame, rows: int = LOOKUP_ROWS, size: int = LOOKUP_BYTES) -> DataFrame:
    """Mark a lookup for broadcast if it ``is_small``.

    Lookups have few different keys, so a join by key would send most rows to few tasks; a larger lookup is joined by key
    nevertheless, and the adaptive join splits its hot keys.
    """
    return F.broadcast(lookup) if is_small(lookup, rows, size) else lookup


def left_fan(spine: DataFrame, sides: list[DataFrame], key: list[str]) -> DataFrame:
    """Left join several sides onto a spine on the same key; the spine is shuffled once. The
    sides should hold few rows per key."""
    return reduce(lambda left, right: left.join(right, key, "left"), sides, spine)


def with_placeholders(side: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """The side plus an empty row for each of the different ``keys`` it lacks.

    An inner join with the result keeps every key, as a left join would. Adaptive execution can
    split hot keys of both sides of an inner join, but none on the right of a left join.
    """
    lacking = keys.join(side.select(key).distinct(), key, "left_anti")
    return side.unionByName(lacking, allowMissingColumns=True)


def left_join_where(left: DataFrame, right: DataFrame, condition: Column, drop: list[str]) -> DataFrame:
    """Left join under any condition (also on left-side columns), then drop helper columns."""
    return left.join(right, condition, "left").drop(*drop)


def renamed(df: DataFrame, prefix: str) -> DataFrame:
    """All columns with a prefix, so that join conditions can name them."""
    return df.select(*[F.col(c).alias(prefix + c) for c in df.columns])
