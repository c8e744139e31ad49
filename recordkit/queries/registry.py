"""Names of the registered queries with their Spark function and their checking SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str) -> Callable[[Query], Query]:
    """Register a query; its result is compared by value, so decimals are shown as doubles and
    dates as ISO text."""

    def register(function: Query) -> Query:
        QUERIES[name] = lambda spark, folder: plain(function(spark, folder))
        SQL[name] = sql
        return function

    return register


def plain(df: DataFrame) -> DataFrame:
    shown = {"decimal": "double", "date": "string"}
    return df.select(
        *[
            F.col(f"`{f.name}`").cast(shown[f.dataType.typeName()]).alias(f.name) if f.dataType.typeName() in shown else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )
