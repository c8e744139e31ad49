"""What an upload holds that the reports cannot read."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from recordkit.functions.rules import is_reject, uploaded_id
from recordkit.sources.tables import Upload


def bad_id(text: Column) -> Column:
    """True where text is present but is not exactly a number's own text, so that it matches no record."""
    return text.isNotNull() & uploaded_id(text).isNull()


def rejected_values(upload: DataFrame, name: str, ids: list[str], numbers: list[str]) -> DataFrame:
    """``upload``, ``column``, ``value`` and ``rows`` for each different value that is present but cannot be read: ids that
    match no number exactly, and scores that are no whole number. One pass over the upload."""
    checked = [*ids, *numbers]
    rows = upload.select(*[F.col(c).cast("string").alias(c) for c in checked]).unpivot([], checked, "column", "value")
    wrong = F.when(F.col("column").isin(ids), bad_id(F.col("value"))).otherwise(is_reject(F.col("value")))
    counted = rows.filter(wrong).groupBy("column", "value").agg(F.count(F.lit(1)).alias("rows"))
    return counted.select(F.lit(name).alias("upload"), "column", "value", "rows")


def rejected_rows(malformed: DataFrame, name: str) -> DataFrame:
    """The same columns for whole rows with too few or too many fields (``whole_row``): ``column`` is NULL, ``value`` the row's text."""
    counted = malformed.groupBy(F.col("whole_row").alias("value")).agg(F.count(F.lit(1)).alias("rows"))
    return counted.select(F.lit(name).alias("upload"), F.lit(None).cast("string").alias("column"), "value", "rows")


def upload_rejects(uploads: dict[str, tuple[Upload, list[str], list[str]]]) -> DataFrame:
    """Values and whole rows of several uploads that cannot be read: name -> upload, id columns, number columns."""
    values = rejects({name: (upload.rows, ids, numbers) for name, (upload, ids, numbers) in uploads.items()})
    return reduce(DataFrame.unionByName, [rejected_rows(upload.malformed, name) for name, (upload, _, _) in uploads.items()], values)


def rejects(uploads: dict[str, tuple[DataFrame, list[str], list[str]]]) -> DataFrame:
    """``rejected_values`` of several uploads: name -> table, id columns, number columns."""
    return reduce(DataFrame.unionByName, [rejected_values(table, name, ids, numbers) for name, (table, ids, numbers) in uploads.items()])
