"""Session settings the library relies on, for tests, the bench and stand-alone jobs."""

from __future__ import annotations

from pyspark.sql import SparkSession

# AQE splits hot join partitions, also where that needs one more shuffle for the next step.
SKEW_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


def prepare(spark: SparkSession) -> SparkSession:
    """Switch the skew settings on in a given session."""
    for key, value in SKEW_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(cpus: str | int = 8, app: str = "recordkit", **settings: str) -> SparkSession:
    """A local session with the Spark UI off. On a cluster, pass your own session instead."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
    )
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = prepare(builder.getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark
