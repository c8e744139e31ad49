"""Option ids decoded to their code or label."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from recordkit.operators.joins import small_lookup
from recordkit.sources.tables import stage


def one_option_per_id(options: DataFrame, id_col: str = "id", code: str = "code", label: str = "label") -> DataFrame:
    """The lookup reduced to one row per id, so that decoding never adds rows. It is stored once
    for all columns it decodes, and marked for broadcast if it is small (an option column has few
    different ids)."""
    reduced = (
        options.groupBy(F.col(id_col).cast("bigint").alias("option_id"))
        .agg(F.min(F.struct(F.col(code).alias("code"), F.col(label).alias("label"))).alias("o"))
        .select("option_id", "o.code", "o.label")
    )
    return small_lookup(stage(reduced, "options"))


def decode_options(df: DataFrame, options: DataFrame, columns: dict[str, tuple[str | Column, str]]) -> DataFrame:
    """Add decoded columns: ``{new column: (option id column, "code" or "label")}``.

    ``options`` comes from ``one_option_per_id``. One left join per option column.
    """
    for new, (source, part) in columns.items():
        side = options.select(F.col("option_id").alias("_id"), F.col(part).alias(new))
        key = F.col(source) if isinstance(source, str) else source
        df = df.join(side, key.cast("bigint") == F.col("_id"), "left").drop("_id")
    return df
