"""Flags, bands and text-to-number rules."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

# Proficiency bands from level 1 to level 5.
BANDS = ("Inadequate", "Below Satisfactory", "Satisfactory", "Proficient", "Mastery")


def flag(condition: Column, source: Column) -> Column:
    """1 where the condition holds, NULL where the source is missing, else 0."""
    return F.when(condition, 1).when(source.isNotNull(), 0)


def presence_flag(source: Column) -> Column:
    """1 where a value is present, else 0."""
    return source.isNotNull().cast("int")


def yes_no(condition: Column) -> Column:
    """``Yes`` where the condition is true, ``No`` where it is false or unknown."""
    return F.when(condition, "Yes").otherwise("No")


def change_flag(left: Column, right: Column) -> Column:
    """``Y`` where both sides are known and differ; NULL on either side means no change."""
    return F.when(left != right, "Y")


def any_flag(flags: list[Column]) -> Column:
    """``Y`` if any flag is ``Y``, else NULL."""
    return F.when(reduce(lambda a, b: a | b, [F.coalesce(f, F.lit("N")) == "Y" for f in flags]), "Y")


def band_level(text: Column, bands: tuple[str, ...] = BANDS) -> Column:
    """Position of a band name in ``bands`` counted from 1; NULL for any other text."""
    position = F.array_position(F.array(*[F.lit(b) for b in bands]), text)
    return F.nullif(position, F.lit(0)).cast("int")


def growth(later: Column, earlier: Column) -> Column:
    """Difference of two text scores; text that is no whole number gives NULL (see ``is_reject``)."""
    return later.try_cast("bigint") - earlier.try_cast("bigint")


def uploaded_id(text: Column) -> Column:
    """A text id as a number where its text is exactly that number, else NULL.

    Joining on it gives the same matches as comparing texts, but on the number the other tables
    are partitioned by.
    """
    number = text.try_cast("bigint")
    return F.when(number.cast("string") == text, number)


def is_reject(text: Column) -> Column:
    """True where text is present but is no whole number."""
    return text.isNotNull() & text.try_cast("bigint").isNull()


def percent(part: Column, whole: Column, places: int = 2) -> Column:
    """``part / whole * 100`` rounded; both sides are narrowed so that rounding happens once."""
    narrow = "decimal(18,4)"
    return F.round(F.try_divide(part.cast(narrow), whole.cast(narrow)) * 100, places)


def ratio(part: Column, whole: Column, places: int = 4) -> Column:
    """``part / whole`` rounded once, NULL when ``whole`` is 0.

    Spark's quotient of two wide decimals keeps six digits, so rounding it to four rounds
    twice; both sides are narrowed first, which leaves twenty.
    """
    narrow = "decimal(18,4)"
    return F.round(F.try_divide(part.cast(narrow), whole.cast(narrow)), places)


def masked_id(col: Column, *offsets: int) -> Column:
    """Subtract constant offsets. Reversible: this hides an id, it does not anonymise it."""
    return reduce(lambda value, offset: value - F.lit(offset), offsets, col)


def derived_yes_no(identifier: Column) -> Column:
    """``Yes`` for an even id or one that ends in 7 or 9, else ``No``."""
    last_digit = F.right(identifier.cast("string"), F.lit(1))
    return yes_no((identifier % 2 == 0) | last_digit.isin("7", "9"))
