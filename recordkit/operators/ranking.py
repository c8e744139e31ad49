"""Rank within a group when a group may be far larger than one task can sort."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from recordkit.sources.tables import stage


def _places(stacked: DataFrame, names: list[str], bucket_width: float) -> DataFrame:
    """``_rank`` and ``_size`` (rows of the group) per different (group, ``_kind``, ``_v``)."""
    width = F.lit(str(bucket_width)).cast("decimal(18,4)")
    counts = stacked.groupBy(*names, "_kind", "_v").agg(F.count(F.lit(1)).alias("_n")).withColumn("_b", F.floor(F.col("_v") / width))
    counts = stage(counts, "value-counts")  # a row per different value; read for the values and for their buckets
    higher = Window.partitionBy(*names, "_kind").orderBy(F.desc_nulls_first("_b"))
    whole_group = Window.partitionBy(*names, "_kind")
    buckets = (
        counts.groupBy(*names, "_kind", "_b")
        .agg(F.sum("_n").alias("_bn"))
        .withColumn("_above", F.sum("_bn").over(higher) - F.col("_bn"))
        .withColumn("_size", F.sum("_bn").over(whole_group))
        .drop("_bn")
    )
    inside = Window.partitionBy(*names, "_kind", "_b").orderBy(F.desc_nulls_first("_v"))
    ranked = counts.withColumn("_ahead", F.sum("_n").over(inside) - F.col("_n"))
    rank = (F.col("_above") + F.col("_ahead") + 1).alias("_rank")
    joined = ranked.join(buckets, _same(ranked, buckets, [*names, "_kind", "_b"]))
    return joined.select(*[ranked[c].alias(f"{c}_at") for c in [*names, "_kind", "_v"]], rank, "_size")


def _same(left: DataFrame, right: DataFrame, columns: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [left[c].eqNullSafe(right[c]) for c in columns])


def rank_in_group(df: DataFrame, group: list[str], ranks: dict[str, str], size: str | None = None, bucket_width: float = 0.1) -> DataFrame:
    """``RANK`` (gaps, highest first, NULL before all) of each value column within ``group``.

    ``ranks`` maps value column -> new rank column; ``size`` names a new column with the number of
    rows of the group. The values must be decimals. The rows are stored. Their value columns are stacked as (kind, value) and counted per different
    value in one pass for all kinds (combined before the shuffle), so a value shared by a third of all rows is one row afterwards.
    The values of a group and kind are cut into buckets of ``bucket_width``: no window holds more than the
    different values of one bucket (``bucket_width / 10**-scale``) or the buckets of one group. The
    counts of higher buckets and of higher values in the same bucket add up to the rank. Each stacked value looks its rank up, the
    ranks of a row are put side by side by its place in the stored files, and one join brings them back.
    """
    for value in ranks:
        value_type = df.schema[value].dataType
        if value_type.typeName() != "decimal":
            raise TypeError(f"{value} must be a decimal, not {value_type.simpleString()}")
    stored = stage(df, "rows-to-rank").select("*", F.struct("_metadata.file_name", "_metadata.row_index").alias("_row"))
    names = [f"_g{i}" for i in range(len(group))]
    kinds = F.array(*[F.struct(F.lit(i).alias("_kind"), F.col(value).alias("_v")) for i, value in enumerate(ranks)])
    stacked = stored.select(*[F.col(g).alias(n) for g, n in zip(group, names)], "_row", F.inline(kinds))
    places = _places(stacked, names, bucket_width)
    found = stacked.join(places, reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"{c}_at")) for c in [*names, "_kind", "_v"]]))
    beside = found.groupBy(F.col("_row").alias("_ranked")).agg(
        *[F.max(F.when(F.col("_kind") == i, F.col("_rank"))).alias(rank) for i, rank in enumerate(ranks.values())],
        *([F.max("_size").alias(size)] if size else []),
    )
    return stored.join(beside, F.col("_row") == F.col("_ranked")).drop("_row", "_ranked")
