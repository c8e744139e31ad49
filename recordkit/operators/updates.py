"""Keyed bulk updates as new table contents."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from recordkit.sources.tables import stage
from recordkit.sources.versions import Version, file_name, publish_files, write_files


@dataclass(frozen=True)
class UpdateResult:
    """``table``: the new contents. ``conflicts``: keys offered more than one value, with the
    number of different values and the one that was taken."""

    table: DataFrame
    conflicts: DataFrame


def one_value_per_key(source: DataFrame, key: list[str], value: str) -> DataFrame:
    """The most frequent value per key, the smallest among equals, with the number of choices.

    Values are counted per (key, value) first, and the choice is a minimum over structs, so a key
    that holds a third of the source is combined before each shuffle.
    """
    counted = source.groupBy(*key, value).agg(F.count(F.lit(1)).alias("_n"))
    best = F.min(F.struct((-F.col("_n")).alias("_order"), F.col(value).alias("_new")))
    return (
        counted.groupBy(*key)
        .agg(best.alias("_best"), F.count(F.lit(1)).alias("choices"))
        .select(*key, F.col("_best._new").alias("_new"), "choices")
    )


def keyed_update(
    target: DataFrame, source: DataFrame, on: dict[str, str], column: str, value: str, transform=None
) -> UpdateResult:
    """Set ``column`` from ``source.value`` where all keys match; other rows stay as they are.

    ``on`` maps target column -> source column. NULL keys never match. ``transform`` is applied
    to the chosen value (for example a cast). A matched NULL value is written as NULL.
    """
    reduced = one_value_per_key(source, list(on.values()), value)
    conflicts = reduced.filter("choices > 1").withColumnRenamed("_new", value)
    return UpdateResult(_updated(target, _chosen(reduced, target, on, column, transform), on, column), conflicts)


def _chosen(reduced: DataFrame, target: DataFrame, on: dict[str, str], column: str, transform) -> DataFrame:
    """The value of each offered key, in the type of the target's column."""
    new_value = transform(F.col("_new")) if transform else F.col("_new")
    return reduced.select(*[F.col(s).alias(f"_key_{t}") for t, s in on.items()], new_value.cast(target.schema[column].dataType).alias("_new"), F.lit(True).alias("_matched"))


def _same_key(on: dict[str, str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(t) == F.col(f"_key_{t}") for t in on])


def _within(reduced: DataFrame, target: T.StructType, on: dict[str, str]) -> Column:
    """Whether each key is between the least and the largest offered one, where both sides have the same type: other rows cannot have a changed value."""
    plain = (T.IntegralType, T.DateType)
    kinds = {t: s for t, s in on.items() if target[t].dataType == reduced.schema[s].dataType and (isinstance(target[t].dataType, plain) or target[t].dataType == T.StringType())}
    ends = [f(F.col(s)).alias(f"{name}_{t}") for t, s in kinds.items() for name, f in (("least", F.min), ("most", F.max))]
    bounds = reduced.agg(F.count(F.lit(1)), *ends).first()
    return reduce(lambda a, b: a & b, [F.col(t).between(bounds[f"least_{t}"], bounds[f"most_{t}"]) for t in kinds], F.lit(True))


def _updated(target: DataFrame, chosen: DataFrame, on: dict[str, str], column: str) -> DataFrame:
    updated = F.when(F.col("_matched"), F.col("_new")).otherwise(F.col(column))
    return target.join(chosen, _same_key(on), "left").select(*[updated.alias(column) if c == column else F.col(c) for c in target.columns])


def _file_mark() -> Column:
    """A number for the file a row of a stored table is in, made from its own name, which Spark gives once: a path would be shuffled with each row."""
    return F.xxhash64("_metadata.file_name")


def _listed(spark: SparkSession, names: Iterable[str]) -> DataFrame:
    """Names of files with their places and marks."""
    listed = spark.range(1).select(F.posexplode(F.split(F.lit("\n".join(names)), "\n")).alias("pos", "name"))
    return listed.withColumn("mark", F.xxhash64(F.substring_index("name", "/", -1)))


@dataclass(frozen=True)
class FileUpdate:
    """``version``: the published new version; ``conflicts`` as in ``UpdateResult``; ``rewritten``: the old version's files that it replaces."""

    version: Version
    conflicts: DataFrame
    rewritten: tuple[str, ...]


def keyed_update_files(
    old: Version, source: DataFrame, on: dict[str, str], column: str, value: str, transform=None
) -> FileUpdate:
    """``keyed_update`` on a stored table: only files that hold a row whose value changes are written anew.

    The keys and the column are read, with the file each row is in, from rows between the least and the largest offered key, and meet the offered values; of the table's other columns, those of files with a
    change are read and no others. Each rewritten file's rows make one new file, so files keep the ranges they had. The new version is published in one step if as many rows
    were written as read, and raises ``Conflict`` if another was published meanwhile. Without any change the old version stays current.
    """
    spark = source.sparkSession
    reduced = stage(one_value_per_key(source, list(on.values()), value), "offered-values")
    conflicts = reduced.filter("choices > 1").withColumnRenamed("_new", value)
    chosen = _chosen(reduced, old.read(spark), on, column, transform)
    if not old.files:
        return FileUpdate(old, conflicts, ())
    near = old.read(spark).filter(_within(reduced, old.schema, on))
    placed = near.select(*on, column, _file_mark().alias("_file"))
    changes = placed.join(chosen, _same_key(on)).filter(~F.col(column).eqNullSafe(F.col("_new"))).select("_file").distinct()
    marks = {r["_file"] for r in changes.collect()}  # one for each file of this table at most
    rewritten = tuple(sorted(r["name"] for r in _listed(spark, old.files).collect() if r["mark"] in marks))
    if not rewritten:
        return FileUpdate(old, conflicts, ())
    before = old.read(spark, rewritten)
    numbers = _listed(spark, rewritten).select(F.col("mark").alias("_mark"), F.col("pos").alias("_number"))
    numbered = before.withColumn("_mark", _file_mark()).join(F.broadcast(numbers), "_mark").drop("_mark")
    placed = _updated(numbered, chosen, on, column).repartitionById(len(rewritten), F.col("_number"))
    written = write_files(placed.drop("_number"), old.root)
    files = tuple(sorted({*old.files} - {*rewritten})) + written
    new = Version(old.root, old.number + 1, old.schema, files)
    if (n := before.count()) != (m := new.read(spark, written).count()):
        raise ValueError(f"{old.root}: {n} rows became {m}")
    return FileUpdate(publish_files(spark, old.root, new.number, new.schema, files, old.note), conflicts, rewritten)


def merge_files(old: Version, offered: DataFrame, key: list[str], combine: dict[str, Callable[[Column, Column], Column]], note: str = "") -> Version:
    """Publish a stored table with ``offered`` rows merged in: a known key's columns become ``combine`` of their old and offered value, a new key's row is added.

    Both have one row per key (NULL is a key) and the same columns. Only files that hold a row that changes are written anew, with
    the new rows, in ranges of the key; the version carries ``note``. Raises ``Conflict`` if another version was published meanwhile.
    """
    spark = offered.sparkSession
    offered = stage(offered.select(*[F.col(c).cast(old.schema[c].dataType).alias(c) for c in old.schema.names]), "offered-rows")
    side = offered.select(*[F.col(c).alias(f"_new_{c}") for c in offered.columns], F.lit(True).alias("_offered"))
    condition = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_new_{k}")) for k in key])
    merged = {c: F.when(F.col("_offered"), f(F.col(c), F.col(f"_new_{c}"))).otherwise(F.col(c)) for c, f in combine.items()}
    fresh, rewritten = offered, ()
    if old.files:
        known = old.read(spark).select(*key, *combine, F.col("_metadata.file_path").alias("_file")).join(side, condition)
        differs = reduce(lambda a, b: a | b, [~F.col(c).eqNullSafe(m) for c, m in merged.items()])
        rewritten = tuple(sorted(file_name(r["_file"]) for r in known.filter(differs).select("_file").distinct().collect()))
        fresh = stage(offered.join(old.read(spark).select(*[F.col(k).alias(f"_old_{k}") for k in key]), reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_old_{k}")) for k in key]), "left_anti"), "new-rows")
    before = old.read(spark, rewritten)
    changed = before.join(side, condition, "left").select(*[merged[c].alias(c) if c in merged else F.col(c) for c in before.columns])
    rows = before.count() + fresh.count()
    written = write_files(changed.unionByName(fresh), old.root, key) if rows else ()
    files = tuple(sorted({*old.files} - {*rewritten})) + written
    if (n := Version(old.root, 0, old.schema, written).read(spark).count()) != rows:
        raise ValueError(f"{old.root}: {rows} rows became {n}")
    return publish_files(spark, old.root, old.number + 1, old.schema, files, note)
