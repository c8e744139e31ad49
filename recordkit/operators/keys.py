"""Newest-row and open-row choices per key.

Order is newest first with a NULL date as the newest (a record without an end is still running),
then the tie columns ascending. Give tie columns that tell all rows apart, so that a retried task
chooses the same row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from recordkit.sources.tables import stage


def newest_first(date: str, ties: list[str]) -> list[Column]:
    return [F.desc_nulls_first(date), *[F.asc_nulls_first(t) for t in ties]]


def newest_place(date: str, ties: list[str]) -> Column:
    """A struct that is smallest for the row ``newest_first`` would put first.

    A minimum over it is combined before the shuffle, where a window would sort whole keys.
    """
    newest = F.struct(F.col(date).isNotNull().alias("ended"), (-F.unix_date(F.col(date))).alias("days_back"))
    return F.struct(newest.alias("newest"), *[F.col(t).alias(t) for t in ties])


def latest_per_key(df: DataFrame, key: list[str], date: str, ties: list[str]) -> DataFrame:
    """One row per key: the newest by ``date``.

    A plain ``rn = 1`` filter lets Spark keep one row per key and task before the shuffle, so a
    key that holds a third of the rows sends no more rows than there are tasks.
    """
    window = Window.partitionBy(*key).orderBy(*newest_first(date, ties))
    return df.withColumn("_rn", F.row_number().over(window)).filter("_rn = 1").drop("_rn")


def active_or_latest(df: DataFrame, key: list[str], end: str, ties: list[str]) -> DataFrame:
    """Every open row (NULL ``end``) plus the newest row of each key, without duplicates.

    Adds ``withdrawn``: ``Y`` for a closed row. ``rn = 1 OR end IS NULL`` in one window would sort
    a whole key in one task, so the two parts are taken apart: open rows need no window, and the
    newest row is kept only where it is closed (if it is open it is among the open rows).
    """
    still_open = df.filter(F.col(end).isNull())
    closed_newest = latest_per_key(df, key, end, ties).filter(F.col(end).isNotNull())
    kept = still_open.unionByName(closed_newest).distinct()
    return kept.withColumn("withdrawn", F.when(F.col(end).isNotNull(), "Y").otherwise("N"))


def first_row_flags(df: DataFrame, key: list[str], orders: dict[str, str]) -> DataFrame:
    """Mark, per flag, the row a descending ``row_number`` over ``key`` would number 1.

    ``orders`` maps flag name -> date column; all other columns break ties ascending. A window
    would sort a whole key in one task. Here the rows are stored, the winner of each key is a
    minimum that is combined before the shuffle, and every row is compared with it. The place of a
    row in the stored files tells equal rows apart, so exactly one of their copies is marked and
    copies need not be gathered.
    """
    columns = df.columns
    stored = stage(df, "rows-to-mark").select("*", F.struct("_metadata.file_name", "_metadata.row_index").alias("_row"))

    def winner(date: str) -> Column:
        place = newest_place(date, [*[c for c in columns if c != date], "_row"])
        return F.min(place)["_row"]

    winners = stored.groupBy(*[F.col(k).alias(f"_k_{k}") for k in key]).agg(
        *[winner(date).alias(f"_first_{flag}") for flag, date in orders.items()]
    )
    same_key = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in key]
    flags = [(F.col("_row") == F.col(f"_first_{flag}")).alias(flag) for flag in orders]
    return stored.join(winners, same_key).select(*columns, *flags)


def first_rows_of_join(left: DataFrame, right: DataFrame, on: list[str], key: list[str], orders: dict[str, str], columns: list[str]) -> DataFrame:
    """The rows that ``first_row_flags`` marks in the inner join of two tables, without the join.

    Rows of a side are independent of the other side's within one value of ``on``, so the first row of the product is made of the
    first row of each side, each in the order of its own columns, however the columns of both alternate. Each side gives one
    row per ``on``; only these meet, and the first per ``key`` (part of ``on``) is a minimum again. ``orders`` maps flag -> date column, ``columns`` are the
    other columns that break ties ascending, in their order, before those of ``on``.

    One row per key and different first row: the columns, ``on``, and a flag per order. NULLs in ``on`` match nothing.
    """
    rest = [c for c in on if c not in key]
    sides = {c: name for name, side in (("l", left), ("r", right)) for c in columns if c in side.columns and c not in on}

    def parts(date: str) -> list[tuple[str, Column | None]]:
        """Order parts by name, each with its expression on the side that has it (None for ``on``)."""
        first = [("_newest", newest_place(date, [])["newest"])] if date in sides else []
        return [*first, *[(c, F.col(c)) for c in columns if c != date and c in sides], *[(c, None) for c in rest], (date, F.col(date))]

    def least(name: str, side: DataFrame) -> DataFrame:
        def own(date: str) -> list[Column]:
            return [e.alias(c) for c, e in parts(date) if e is not None and sides[date if c == "_newest" else c] == name] or [F.lit(0).alias("_none")]

        return side.groupBy(*on).agg(*[F.min(F.struct(*own(date))).alias(f"_{name}_{flag}") for flag, date in orders.items()])

    met = least("l", left).join(least("r", right), on)

    def place(flag: str, date: str) -> Column:
        def found(c: str) -> Column:
            side = sides.get(date if c == "_newest" else c)
            return F.col(c) if side is None else F.col(f"_{side}_{flag}")[c]

        return F.min(F.struct(*[found(c).alias(c) for c, _ in parts(date)]))

    shown = [*columns, *rest]
    winners = met.groupBy(*key).agg(*[place(flag, date).alias(flag) for flag, date in orders.items()])
    winners = winners.select(*key, *[F.struct(*[F.col(flag)[c].alias(c) for c in shown]).alias(flag) for flag in orders])
    each = winners.withColumn("_row", F.explode(F.array_distinct(F.array(*orders))))
    return each.select(*key, *[F.col("_row")[c].alias(c) for c in shown], *[F.col("_row").eqNullSafe(F.col(flag)).alias(flag) for flag in orders])
