"""The given tables as typed DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

MONEY = "decimal(18,2)"


def read_given(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


class Tables:
    """Parquet tables of one folder, read on first use."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self._read: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name not in self._read:  # asking for a schema runs a job
            self._read[name] = read_given(self.spark, self.folder, name)
        return self._read[name]

    def order_spans(self) -> DataFrame:
        """Orders as records with a start date and an end date that is NULL while open."""
        day = F.col("o_orderdate").cast("date")
        return self.orders.select(
            "o_orderkey",
            "o_custkey",
            "o_orderstatus",
            "o_orderpriority",
            F.col("o_totalprice").cast(MONEY).alias("total"),
            day.alias("start_date"),
            F.when(F.col("o_orderstatus") != "O", day).alias("end_date"),
        )
