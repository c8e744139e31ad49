"""Helpers that several operators share: table reads, row functions on Arrow batches, the held-out mark, kept rows."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from recordkit.sources.tables import read_table, stage

# Rows that a row function handles, and hands on, at a time.
ROWS_AT_ONCE = 256
# Bytes of finished rows after which they are handed on at once.
BYTES_AT_ONCE = 4 << 20


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return read_table(spark, f"{folder}/{name}.parquet")


def held_out(doc_id: Column) -> Column:
    """True for the fifth of the rows from which nothing is learned; a null id counts as held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def map_rows(
    df: DataFrame,
    columns: list[str],
    function: Callable[[Iterator[tuple]], Iterable[tuple]],
    schema: str | T.StructType,
) -> DataFrame:
    """Run ``function`` over the rows of each partition: an iterator of tuples of ``columns`` in, tuples of ``schema`` out.

    Rows arrive one Arrow slice at a time, so memory is bounded by one slice and what the function keeps.
    """
    wanted = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    arrow = to_arrow_schema(wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for batch in batches:
                for start in range(0, batch.num_rows, ROWS_AT_ONCE):
                    part = batch.slice(start, ROWS_AT_ONCE)
                    yield from zip(*(column.to_pylist() for column in part.columns))

        done: list[tuple] = []
        size = 0
        for row in function(rows()):
            done.append(row)
            size += sum(len(value) for value in row if isinstance(value, (bytes, str)))
            if len(done) >= 8 * ROWS_AT_ONCE or size >= BYTES_AT_ONCE:
                yield batch_of(done, arrow)
                done, size = [], 0
        if done:
            yield batch_of(done, arrow)

    return df.select(*[F.col(f"`{c}`") for c in columns]).mapInArrow(run, wanted)


def batch_of(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns: Iterable[Any] = zip(*rows)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def words_of(texts: list[bytes]) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts, empty ones beside outer white space, and where each text's words begin and the last one's end."""
    ends = np.cumsum([0, *map(len, texts)])
    whole = pa.LargeStringArray.from_buffers(len(texts), pa.py_buffer(ends), pa.py_buffer(b"".join(texts)))
    lists = pc.ascii_split_whitespace(whole)
    return lists.values.view(pa.large_binary()), lists.offsets.to_numpy()


def row_numbers() -> Iterator[int]:
    """Numbers that no other task gives. A task that runs again may number other rows so: write them before use."""
    context = TaskContext.get()
    first = (context.partitionId() if context else 0) << 36
    while True:
        yield first
        first += 1


def rows_named(docs: DataFrame, names: DataFrame, keys: dict[str, Column], how: str = "left_semi") -> DataFrame:
    """Rows of ``docs`` whose ``keys`` (column of ``names`` -> expression on ``docs``) are among ``names``; nulls match."""
    # By key at every size: a plan that turns from broadcast to shuffle somewhere would not grow with its input.
    renamed = names.select(*[F.col(k).alias(f"__named_{i}") for i, k in enumerate(keys)]).hint("merge")
    condition = None
    for i, expression in enumerate(keys.values()):
        one = expression.eqNullSafe(renamed[f"__named_{i}"])
        condition = one if condition is None else condition & one
    return docs.join(renamed, condition, how)


def numbered(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """``df`` with ``name``, each row's place in ``order`` from 1 on, written.

    Rows are dealt by ranges of the order, so that no task holds more than its range, whatever key is frequent; the place
    is the row's place within its range and the rows of the ranges before it, of which there are as many as partitions.
    """
    spark = df.sparkSession
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__at", F.monotonically_increasing_id())
    written = stage(ranged, "ordered-rows")
    part = F.shiftright("__at", 33)
    before, offsets = 0, []
    for r in sorted(written.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).collect()):
        offsets.append((r["part"], before))
        before += r["n"]
    earlier = F.broadcast(spark.createDataFrame(offsets, "__part long, __before long"))  # a row per partition at most
    place = F.col("__before") + F.col("__at").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    return written.join(earlier, part == F.col("__part")).withColumn(name, place).drop("__at", "__part", "__before")
