"""Exact dedup by chunk recipes: chunks become verified identifiers, and texts are compared as ordered identifier lists."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import zstandard
from pyspark.sql import DataFrame, Window, functions as F

from recordkit.llm.chunking import cuts
from recordkit.llm.common import map_rows, row_numbers
from recordkit.sources.tables import stage

# Chunk names that a task remembers, so that it sends a chunk once; it forgets them when full.
REMEMBERED = 200_000


def _recipes(rows: Iterator[tuple], mean: int, name_bytes: int, every: bool) -> Iterator[tuple]:
    """A row for each text with its recipe, and rows for its chunks (``every``: all of them with their place)."""
    numbers, sent = row_numbers(), set()
    squeeze = zstandard.ZstdCompressor(level=3)
    for doc_id, text in rows:
        data, row, start, recipe = (text or "").encode("utf-8", "surrogatepass"), next(numbers), 0, []
        for place, end in enumerate(cuts(data, mean, mean // 4, 16 * mean)):
            chunk = data[start:end]
            name = hashlib.blake2b(chunk, digest_size=name_bytes).digest()
            start = end
            recipe.append(name)
            if every:
                yield None, row, None, None, place, name, squeeze.compress(chunk)
            elif (held := (name, hash(chunk))) not in sent:
                if len(sent) >= REMEMBERED:
                    sent.clear()
                sent.add(held)
                yield None, row, None, None, place, name, squeeze.compress(chunk)
        yield doc_id, row, hashlib.sha256(data).hexdigest(), b"".join(recipe), None, None, None


def exact_groups(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", mean: int = 4096, name_bytes: int = 16) -> DataFrame:
    """Which row of equal texts stays: one row per input row with ``doc_id``, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    Chunks are cut by content (``mean`` bytes on average, 16 times that at most) and named by a digest. Chunks of one
    name are compared byte by byte; if two differ under one name, the identifier is the name and a number within it.
    Texts are equal when their lists of identifiers are. A long text moves once, as chunks that its task has not sent
    before; all later steps move identifiers.

    Of equal texts the row with the largest id stays, of repeated rows with that id one. A null text counts as empty
    (an empty recipe). A null id is smaller than any; ``keep_id`` is null if all ids of a group are. Other columns are
    not read. No rows give no rows.
    """
    spark = docs.sparkSession
    schema = f"doc_id {docs.schema[id_column].dataType.simpleString()}, row long, text_sha256 string, recipe binary, place int, name binary, piece binary"
    work = partial(_recipes, mean=mean, name_bytes=name_bytes, every=False)
    written = stage(map_rows(docs, [id_column, text_column], work, schema), "chunk-recipes")
    texts = written.filter("recipe is not null").select("doc_id", "row", "text_sha256", "recipe")
    # Both counts use one shuffle by name; a name holds at most one row per task and chunk.
    different = written.filter("name is not null").select("name", "piece").repartition("name").distinct()
    shared_names = stage(different.groupBy("name").agg(F.count(F.lit(1)).alias("chunks")).filter("chunks > 1").select("name"), "chunk-names-shared")
    if not shared_names.isEmpty():
        again = partial(_recipes, mean=mean, name_bytes=name_bytes, every=True)
        places = stage(map_rows(docs, [id_column, text_column], again, schema), "chunk-places")
        chunks = places.filter("name is not null").select("row", "place", "name", "piece")
        within = Window.partitionBy("name").orderBy("piece")  # the few different chunks of one name
        numbers = different.join(shared_names, "name", "left_semi").withColumn("number", F.row_number().over(within))
        told = chunks.join(numbers, ["name", "piece"], "left").select(
            "row", F.struct("place", F.concat(F.hex("name"), F.lpad(F.hex(F.coalesce("number", F.lit(0))), 16, "0")).alias("id")).alias("at")
        )
        lists = told.groupBy("row").agg(F.array_sort(F.collect_list("at")).alias("at"))
        joined = lists.select("row", F.unhex(F.array_join(F.transform("at", lambda x: x["id"]), "")).alias("verified"))
        texts = (
            places.filter("recipe is not null").join(joined, "row", "left")
            .select("doc_id", "row", "text_sha256", F.coalesce("verified", "recipe").alias("recipe"))
        )
    groups = texts.groupBy("recipe").agg(F.count(F.lit(1)).alias("group_size"), F.max(F.struct("doc_id", "row")).alias("last"))
    groups = stage(groups, "recipe-groups")  # a join with stored groups can be split where a group is large
    return texts.join(groups, "recipe").select(
        "doc_id",
        F.col("last.doc_id").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("last.row")).alias("kept"),
        "text_sha256",
    )
