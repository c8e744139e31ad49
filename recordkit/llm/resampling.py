"""Importance resampling towards a target corpus: bucketed word features weigh each text, and a perturbed draw keeps the best.

Texts are turned into arrays of feature buckets once; one array of gains, a number per bucket, then scores all of them. The
cutoff of the draw lies in a bracket that quantile sketches propose: exact counts outside it show whether it holds the cutoff,
it is widened until it does, and only the rows within it are sorted to find it.
"""

from __future__ import annotations

import math
import string
from collections.abc import Iterator
from functools import partial
from zlib import crc32

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from recordkit.llm.common import map_rows, numbered, row_numbers
from recordkit.sources.tables import stage

LONGEST = 2
# Words whose checksum a task remembers, and the bytes of such a word at most; it forgets them when full.
WORDS, WORD_BYTES = 200_000, 64
# Bytes of a text that are split at a time.
BLOCK = 1 << 20
# Size of the quantile sketches (about a thousandth of the rows off at most), and tasks whose sketches are first merged together.
SKETCH, MERGED = 2_048, 64
NEAR = 0.002
# All but digits, a-z and bytes of other letters is white space; A-Z become a-z.
LOWERED = bytes(b if b >= 128 or chr(b) in string.digits + string.ascii_lowercase else ord(chr(b).lower()) if chr(b) in string.ascii_uppercase else 32 for b in range(256))


def blocks(text: bytes) -> Iterator[list[bytes]]:
    """Words of the text, a block at a time."""
    plain, start = text.translate(LOWERED), 0
    while start < len(plain):
        end = plain.find(b" ", start + BLOCK)
        end = len(plain) if end < 0 else end
        yield plain[start:end].split()
        start = end


def feature_buckets(text: bytes, known: dict[bytes, tuple[int, bytes]], buckets: int) -> tuple[int, np.ndarray]:
    """Number of words, and the bucket of each run of 1 to ``LONGEST`` words."""
    size, tail, out = 0, [], []
    for words in blocks(text):
        found = []
        for word in words:
            one = known.get(word)
            if one is None:
                one = (crc32(word), b" " + word)
                if len(word) <= WORD_BYTES:
                    if len(known) >= WORDS:
                        known.clear()
                    known[word] = one
            found.append(one)
        size += len(found)
        row = tail + found
        sums = [one[0] for one in row]
        out.append(np.array(sums[len(tail) :], dtype=np.uint32))
        for longer in range(1, LONGEST):
            sums = [crc32(last[1], first) for first, last in zip(sums, row[longer:])]
            out.append(np.array(sums[max(0, len(tail) - longer) :], dtype=np.uint32))
        tail = row[len(row) - (LONGEST - 1) :] if len(row) >= LONGEST else row
    every = np.concatenate(out) if out else np.zeros(0, dtype=np.uint32)
    return size, (every % np.uint32(buckets)).astype("<u2")


def _arrays(rows: Iterator[tuple], buckets: int) -> Iterator[tuple]:
    """A row per text with its array of buckets, and one per task with the count of each bucket."""
    numbers, known, held = row_numbers(), {}, np.zeros(buckets, dtype=np.int64)
    for doc_id, text in rows:
        size, found = feature_buckets(text or b"", known, buckets)
        held += np.bincount(found, minlength=buckets)
        yield doc_id, next(numbers), size, found.tobytes(), None
    yield None, None, None, None, held.tobytes()


def _summed(rows: Iterator[tuple], buckets: int) -> Iterator[tuple]:
    held = np.zeros(buckets, dtype=np.int64)
    for (counts,) in rows:
        held += np.frombuffer(counts, dtype=np.int64)
    for bucket in np.flatnonzero(held).tolist():
        yield bucket, int(held[bucket])


def bucket_arrays(docs: DataFrame, id_column: str, text_column: str, buckets: int) -> tuple[DataFrame, np.ndarray]:
    """The written arrays of all texts, and how many features of them fall into each bucket."""
    kind = docs.schema[id_column].dataType.simpleString()
    given = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).cast("binary").alias("text"))
    schema = f"doc_id {kind}, row long, n_words long, found binary, counts binary"
    written = stage(map_rows(given, ["doc_id", "text"], partial(_arrays, buckets=buckets), schema), "feature-buckets")
    summed = map_rows(written.filter("counts IS NOT NULL"), ["counts"], partial(_summed, buckets=buckets), "bucket int, n long")
    total = np.zeros(buckets, dtype=np.int64)
    for r in summed.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # a row per bucket at most
        total[r["bucket"]] = r["n"]
    return written.filter("counts IS NULL").drop("counts"), total


def gains(own: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of a bucket's smoothed share of the target to that of the documents, rounded down."""
    size, all_own, all_target = len(own), int(own.sum()), int(target.sum())
    ratio = [float((int(t) + 1) * (all_own + size)) / float((int(s) + 1) * (all_target + size)) for s, t in zip(own, target)]
    return np.array([math.floor(1000 * math.log(x)) for x in ratio], dtype=np.int64)


def _weights(rows: Iterator[tuple], gain: np.ndarray) -> Iterator[tuple]:
    for doc_id, row, n_words, found in rows:
        which = np.frombuffer(found, dtype="<u2")
        yield doc_id, row, n_words, len(which), int(gain[which].sum()) // len(which) if len(which) else 0


def noise(key: Column, seed: int) -> Column:
    """Thousandths of a Gumbel variable that the seed and the key decide."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")
    return F.floor(F.lit(-1000) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0)))).cast("long")


def sketch_quantiles(scores: DataFrame, shares: list[float], size: int = SKETCH) -> list[int]:
    """About the quantiles of the column ``score``: a sketch per task, merged in two steps."""
    partly = scores.groupBy((F.spark_partition_id() % MERGED).alias("part")).agg(F.kll_sketch_agg_bigint("score", size).alias("sketch"))
    whole = partly.agg(F.kll_merge_agg_bigint("sketch", size).alias("sketch"))
    return list(whole.select(*[F.kll_sketch_get_quantile_bigint("sketch", F.lit(s)) for s in shares]).first())


def bracket(scores: DataFrame, wanted: int, total: int, size: int = SKETCH, near: float = NEAR) -> tuple[int, int, int]:
    """``low``, ``high`` and the exact number of scores above ``high``, such that the ``wanted``-th largest score lies between.

    The sketches propose both ends; while the exact counts outside show that the score sought is not between them, the
    bracket is widened, to all scores at the last.
    """
    while True:
        middle = 1 - wanted / total
        low, high = sketch_quantiles(scores, [max(0.0, middle - near), min(1.0, middle + near)], size)
        edge = scores.agg(F.min("score").alias("low"), F.max("score").alias("high"), F.count(F.when(F.col("score") > high, 1)).alias("above"), F.count(F.when(F.col("score") >= low, 1)).alias("within")).first()
        if edge["above"] < wanted <= edge["within"]:
            return low, high, edge["above"]
        if near >= 1:
            return edge["low"], edge["high"], 0
        near *= 4


def resample(
    docs: DataFrame,
    target: DataFrame,
    percent: int = 25,
    least_words: int = 20,
    seed: int = 7,
    buckets: int = 10_000,
    id_column: str = "doc_id",
    text_column: str = "text",
    target_column: str = "text",
) -> DataFrame:
    """``doc_id``, ``n_features``, ``weight``, ``score`` and ``rank`` (null if not drawn) for every row.

    Words are runs of ASCII digits, letters (A-Z taken as a-z) and all other characters beyond ASCII; features are runs of one and
    two words, in ``buckets`` (65,536 at most) by checksum. ``weight`` is the mean gain of a text's features, ``score`` adds noise
    that the seed and the id decide. Of the rows with ``least_words`` words, ``percent`` in a hundred are drawn, rounded down: the highest
    scores, ties to the smaller id (null first), then in no stated order.

    Null and empty texts have no features and weight 0; a null id has the noise of an empty one. Texts of any length are split a
    block at a time. Repeated rows count and return each. Without target texts every bucket has the same share there. Other
    columns are not read. No rows give no rows.
    """
    if not 0 < buckets <= 1 << 16:
        raise ValueError("buckets: 1 to 65536")
    kind = docs.schema[id_column].dataType.simpleString()
    arrays, own = bucket_arrays(docs, id_column, text_column, buckets)
    _, wanted_counts = bucket_arrays(target.select(F.lit(0).alias("doc_id"), F.col(target_column).alias("text")), "doc_id", "text", buckets)
    schema = f"doc_id {kind}, row long, n_words long, n_features long, weight long"
    weighed = map_rows(arrays, ["doc_id", "row", "n_words", "found"], partial(_weights, gain=gains(own, wanted_counts)), schema)
    scored = stage(weighed.withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed)), "weights")
    shown = ["doc_id", "n_features", "weight", "score"]
    open_rows = scored.filter(F.col("n_words") >= least_words)
    total = open_rows.count()
    wanted = total * percent // 100
    none = F.lit(None).cast("long").alias("rank")
    if not wanted:
        return scored.select(*shown, none)
    low, high, above = bracket(open_rows.select("score"), wanted, total)
    order = [F.desc("score"), F.asc_nulls_first("doc_id"), F.asc("row")]
    inside = numbered(open_rows.filter(F.col("score").between(low, high)).select(*shown, "row"), order, "place")
    best = numbered(open_rows.filter(F.col("score") > high).select(*shown, "row"), order, "place")
    place = F.col("place") + above
    rest = scored.filter((F.col("n_words") < least_words) | (F.col("score") < low))
    return (
        best.select(*shown, F.col("place").alias("rank"))
        .unionByName(inside.select(*shown, F.when(place <= wanted, place).alias("rank")))
        .unionByName(rest.select(*shown, none))
    )
