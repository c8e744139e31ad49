"""Text expressions whose NULL, padding and word rules differ from Spark's defaults."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

WORDS_AND_GAPS = r"[\p{L}\p{N}]+|[^\p{L}\p{N}]+"


def join_text(*parts: Column | str) -> Column:
    """Concatenate, treating NULL as empty text (Spark's ``concat`` would return NULL)."""
    return F.concat_ws("", *parts)


def word_capitals(col: Column | str) -> Column:
    """Capitalise each run of letters and digits: ``o'BRIEN-smith`` -> ``O'Brien-Smith``.

    Spark's ``initcap`` starts a word only after white space.
    """
    pieces = F.regexp_extract_all(col, F.lit(WORDS_AND_GAPS), F.lit(0))
    return F.array_join(F.transform(pieces, F.initcap), "")


def full_name(last: Column | str, first: Column | str) -> Column:
    """``Last, First`` with word capitals; a missing part is left empty."""
    return word_capitals(join_text(last, F.lit(", "), first))


def without(col: Column, *parts: str) -> Column:
    """Remove each literal part, in order."""
    for part in parts:
        col = F.replace(col, F.lit(part), F.lit(""))
    return col


def pad_zeros(col: Column | str, width: int) -> Column:
    """Left pad with zeros to exactly ``width`` characters (longer text is cut)."""
    return F.lpad(col, width, "0")


def month_year_to_date(col: Column) -> Column:
    """``MMYYYY`` text to the first day of that month as ``YYYYMM01`` text."""
    return join_text(F.substring(col, 3, 2**31 - 1), F.substring(col, 1, 2), F.lit("01"))


def school_year_code(label: Column) -> Column:
    """``20182019`` to ``1819`` (characters 3-4 and 7-8); NULL becomes empty text."""
    return join_text(F.substring(label, 3, 2), F.substring(label, 7, 2))


def date_text(col: Column | str) -> Column:
    """A date as ``yyyyMMdd`` text."""
    return F.date_format(F.col(col) if isinstance(col, str) else col, "yyyyMMdd")


def short_number(col: Column, places: int = 2) -> Column:
    """Round half away from zero and drop trailing zeros: 12.0 -> ``12``, 0.050 -> ``0.05``."""
    fixed = F.round(col, places).cast(f"decimal(38,{places})").cast("string")
    return F.regexp_replace(fixed, r"\.?0+$", "") if places else fixed
