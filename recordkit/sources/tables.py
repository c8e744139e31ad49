"""Table reads, all-text uploads, staged results and versioned replacement of tables."""

from __future__ import annotations

import tempfile
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

# The folder of a local session without the setting; made on first use.
_own_folder: list[str] = []


def read_table(spark: SparkSession, name_or_path: str) -> DataFrame:
    """A Parquet path if it looks like one, else a catalog table."""
    is_path = "/" in name_or_path or name_or_path.endswith(".parquet")
    return spark.read.parquet(name_or_path) if is_path else spark.table(name_or_path)


def read_upload(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """An uploaded flat file: every column is text and the header must name ``columns`` in order."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", False)
        .csv(path)
    )


# Holds the text of a row that an upload's columns cannot hold.
WHOLE_ROW = "_whole_row"


@dataclass(frozen=True)
class Upload:
    """``rows``: rows with as many fields as the header; ``malformed``: the text of all others, as ``whole_row``."""

    rows: DataFrame
    malformed: DataFrame


def read_upload_rows(spark: SparkSession, path: str, columns: list[str]) -> Upload:
    """``read_upload`` that sets rows with too few or too many fields, or with an open quote, apart instead of cutting or filling them.

    The file is read once and stored: which rows are malformed shows only when all fields are read. Empty lines are no
    rows. A field cannot hold a line break, since a quote that is open at the end of its line could take any number of lines with it.
    """
    schema = T.StructType([*[T.StructField(c, T.StringType()) for c in columns], T.StructField(WHOLE_ROW, T.StringType())])
    reader = spark.read.schema(schema).option("header", True).option("enforceSchema", False)
    read = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", WHOLE_ROW).csv(path)
    stored = stage(read, "upload")
    return Upload(stored.filter(F.col(WHOLE_ROW).isNull()).drop(WHOLE_ROW), stored.filter(F.col(WHOLE_ROW).isNotNull()).select(F.col(WHOLE_ROW).alias("whole_row")))


def repeated_keys(df: DataFrame, *key: str) -> DataFrame:
    """Keys held by more than one row: such rows multiply in a later join."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir`` or set as checkpoint folder of the context; with
    neither, only a local session gets its own."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    if not _own_folder:
        _own_folder.append(tempfile.mkdtemp(prefix="recordkit-"))
    return _own_folder[0]


def new_folder(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that no other run uses."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str, folder: str | None = None) -> DataFrame:
    """Write a result that several later steps read, and return the written table.

    The file sizes give the planner true statistics, the steps share one row choice, and a lost
    executor costs a re-read instead of a recomputation.
    """
    spark = df.sparkSession
    path = f"{folder}/{label}" if folder else new_folder(spark, label)
    df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(written: DataFrame) -> None:
    """Delete a staged result; only for one that no step, and no result handed out, reads any more."""
    spark = written.sparkSession
    for folder in {path.rsplit("/", 1)[0] for path in written.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(folder))
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def replace_table(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """Create the catalog table ``name`` from ``df``, in place of one that exists.

    The new table is written to a folder of its own below the shared folder, beside the old one, so ``df`` may read the old one and a write that fails leaves it as it
    was. Then the names are switched, and the old table is dropped last. Partition columns are those given, else those
    of the old table.
    """
    spark = df.sparkSession
    exists, mark = spark.catalog.tableExists(name), uuid.uuid4().hex
    if partition_by is None:
        partition_by = [c.name for c in spark.catalog.listColumns(name) if c.isPartition] if exists else []
    new, old = f"{name}_new_{mark}", f"{name}_old_{mark}"
    try:
        df.write.partitionBy(*partition_by).option("path", new_folder(spark, "table")).saveAsTable(new)
    except Exception:
        spark.sql(f"DROP TABLE IF EXISTS {new}")
        raise
    if exists:
        spark.sql(f"ALTER TABLE {name} RENAME TO {old}")
    try:
        spark.sql(f"ALTER TABLE {new} RENAME TO {name}")
    except Exception:
        if exists:
            spark.sql(f"ALTER TABLE {old} RENAME TO {name}")
        raise
    spark.sql(f"DROP TABLE IF EXISTS {old}")
    return spark.table(name)


def publish(versions: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Put new versions of catalog tables under their names; none is switched if one has lost or gained rows."""
    for name, version in versions.items():
        before, after = version.sparkSession.table(name).count(), version.count()
        if before != after:
            raise ValueError(f"{name}: {before} rows became {after}")
    return {name: replace_table(version, name) for name, version in versions.items()}


def write_version(new: DataFrame, old: DataFrame, folder: str, label: str) -> DataFrame:
    """Write a new version of a table beside the old one and check that no row was lost or added.

    The old files stay as they are, so readers switch only when the caller hands out the result.
    """
    written = stage(new, label, folder)
    before, after = old.count(), written.count()
    if before != after:
        raise ValueError(f"{label}: {before} rows became {after}")
    return written
