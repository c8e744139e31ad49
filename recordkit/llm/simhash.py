"""SimHash near-dedup: fingerprints of word shingles, linked through all variants within half the radius."""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import combinations

import numpy as np
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from recordkit.llm.common import map_rows
from recordkit.llm.components import components
from recordkit.sources.tables import stage

BITS = 64
# Shingles whose bits are counted at once.
SHINGLES_AT_ONCE = 1 << 16


def fingerprint(text: str | None, shingle: int, seed: int = 42) -> int:
    """Signed 64-bit fingerprint: a bit is 1 if over half the shingles' hashes have it. No word: zero."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    size = min(shingle, len(words))
    total = len(words) - size + 1
    ones = np.zeros(BITS, dtype=np.int64)
    for start in range(0, total, SHINGLES_AT_ONCE):
        part = words[start : start + SHINGLES_AT_ONCE + size - 1]
        hashes = [xxhash.xxh64_intdigest(b" ".join(one), seed) for one in zip(*(part[i:] for i in range(size)))]
        bits = np.unpackbits(np.array(hashes, dtype="<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int32)
    packed = np.packbits(2 * ones > total, bitorder="little").tobytes()
    return int.from_bytes(packed, "little", signed=True)


def _fingerprints(rows: Iterator[tuple], shingle: int) -> Iterator[tuple]:
    for doc_id, text in rows:
        yield doc_id, fingerprint(text, shingle)


def masks(distance: int) -> list[int]:
    """All 64-bit patterns with at most ``distance`` ones, as signed numbers."""
    out = []
    for ones in range(distance + 1):
        for places in combinations(range(BITS), ones):
            value = sum(1 << p for p in places)
            out.append(value - (1 << BITS) if value >= 1 << (BITS - 1) else value)
    return out


def near_links(prints: DataFrame, radius: int) -> DataFrame:
    """Links (``a`` < ``b``) that connect what fingerprints (column ``print``, different) within ``radius`` bits connect.

    Each fingerprint goes to every variant within half the radius, so two that are near meet at one. At a variant meet at
    most as many as there are variants (65 for two bits), so no bucket grows with the data. For an even radius all of
    a bucket are near each other, and links to its smallest member connect them; for an odd one its pairs are checked.
    """
    variants = masks((radius + 1) // 2)
    spread = prints.select("print", F.explode(F.array(*[F.lit(m) for m in variants])).alias("mask"))
    spread = spread.select("print", F.col("print").bitwiseXOR(F.col("mask")).alias("variant"))
    if radius % 2:
        left, right = spread.withColumnRenamed("print", "a"), spread.withColumnRenamed("print", "b")
        met = left.join(right, "variant").filter("a < b").select("a", "b")
    else:
        bucket = Window.partitionBy("variant")
        met = spread.select(F.min("print").over(bucket).alias("a"), F.col("print").alias("b")).filter("a < b")
    return met.filter(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius).distinct()


def simhash_groups(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", shingle: int = 3, radius: int = 2) -> DataFrame:
    """``doc_id``, ``fingerprint`` (16 hex digits) and ``component_id`` (smallest id reachable over links of at most
    ``radius`` bits) for every row.

    Words are split at ASCII white space of the text with A-Z in lower case; a text with fewer words than a shingle is
    one shingle, a text without words (null, empty, blank) has fingerprint zero, which links like any other. Equal
    fingerprints are one node, so copies and repeated rows cost one node; a repeated row gives a repeated result row.
    A null id is never the smallest, and a component of null ids has a null ``component_id``. Other columns are not
    read. No rows give no rows.
    """
    kind = docs.schema[id_column].dataType.simpleString()
    every = stage(map_rows(docs, [id_column, text_column], partial(_fingerprints, shingle=shingle), f"doc_id {kind}, print long"), "fingerprints")
    prints = stage(every.groupBy("print").agg(F.min("doc_id").alias("least")), "fingerprint-nodes")
    found = components(near_links(prints, radius))
    rooted = prints.join(found.withColumnRenamed("node", "print"), "print", "left").withColumn("root", F.coalesce("component", "print"))
    rooted = stage(rooted.select("print", "root", "least"), "fingerprint-roots")
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(least, "root").select("print", "component_id")
    return every.join(named, "print").select("doc_id", F.lpad(F.lower(F.hex("print")), 16, "0").alias("fingerprint"), "component_id")
