"""Quality rules: plain limits on text statistics, then robust multivariate outliers per language and source.

The second rule estimates place and spread of transformed statistics by minimum covariance determinant: start from
medians and quartiles, then repeat concentration steps (keep the nearest three quarters, estimate again). All steps are
sums per group and distance class, combined before the shuffle, so a group of any size is never gathered.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import partial

import numpy as np
from pyspark.sql import Column, DataFrame, Window, functions as F

from recordkit.llm.common import map_rows
from recordkit.sources.tables import stage

SYMBOLS = "#*$%&|<>"
# Statistics and the least spread that counts, so that one that hardly varies in a group does not reject small changes.
LEAST_SPREAD = {"words": 1.0, "length": 0.1, "symbols": 0.05, "lines": 0.15, "repeats": 0.15}
NAMES = list(LEAST_SPREAD)
SIZE = len(NAMES)
PAIRS = [(i, j) for i in range(SIZE) for j in range(i, SIZE)]
# Distance classes per factor e; classes of a statistic per least spread.
CLASSES, GRID = 32, 8
KEEP = 0.75
POOLED = "*"


def counts(text: str | None) -> tuple[int, int, int, int, int, int]:
    """Words, code points in words, symbols, lines with a word, such lines equal to an earlier one, and words in
    three-word windows that the text holds twice or more."""
    text = text or ""
    words = text.encode("utf-8", "surrogatepass").split()
    inside = len(text) - sum(text.count(c) for c in " \t\n\v\f\r")
    lines = [line for line in text.split("\n") if line.strip(" \t\n\v\f\r")]
    return len(words), inside, sum(text.count(c) for c in SYMBOLS), len(lines), len(lines) - len(set(lines)), repeated(words)


def repeated(words: list[bytes]) -> int:
    if len(words) < 4:
        return 0
    numbers: dict[bytes, int] = {}
    row = np.array([numbers.setdefault(w, len(numbers)) for w in words], dtype=np.int64)
    pairs, kinds = row[:-1] * len(numbers) + row[1:], len(numbers)
    if kinds > 2_000_000:  # else three numbers fit one 63-bit key
        pairs = np.unique(pairs, return_inverse=True)[1]
    _, which, times = np.unique(pairs[:-1] * kinds + row[2:], return_inverse=True, return_counts=True)
    often = times[which] > 1
    covered = np.zeros(len(words), dtype=bool)
    for shift in range(3):
        covered[shift : shift + len(often)] |= often
    return int(covered.sum())


def _counts(rows: Iterator[tuple]) -> Iterator[tuple]:
    for *given, text in rows:
        yield (*given, *counts(text))


def chi_square(x: float, freedom: int) -> float:
    """Distribution function for an odd number of degrees of freedom."""
    total = math.erf(math.sqrt(x / 2))
    for k in range(1, freedom, 2):
        total -= (x / 2) ** (k / 2) * math.exp(-x / 2) / math.gamma(k / 2 + 1)
    return total


def chi_square_edge(share: float, freedom: int) -> float:
    low, high = 0.0, 1000.0
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if chi_square(middle, freedom) < share else (low, middle)
    return high


def shape(mean: np.ndarray, covariance: np.ndarray) -> list[float]:
    """Mean and inverse of the covariance, as one list."""
    return [*mean.tolist(), *np.linalg.inv(covariance).ravel().tolist()]


def _start(rows: Iterator[tuple]) -> Iterator[tuple]:
    least = np.array(list(LEAST_SPREAD.values()))
    for group, edges in rows:
        low, middle, high = (np.array([e[k] for e in sorted(edges)]) for k in (1, 2, 3))
        spread = (high - low) / 1.349  # quartiles of the normal distribution
        yield group, shape(middle * least / GRID, np.diag((spread * least / GRID) ** 2 + least**2))


def _fit(rows: Iterator[tuple], factor: float) -> Iterator[tuple]:
    least = np.diag(np.array(list(LEAST_SPREAD.values())) ** 2)
    for group, n, *sums in rows:
        mean = np.array(sums[:SIZE]) / n
        covariance = np.zeros((SIZE, SIZE))
        for (i, j), value in zip(PAIRS, sums[SIZE:]):
            covariance[i, j] = covariance[j, i] = value / n - mean[i] * mean[j]
        values, vectors = np.linalg.eigh(covariance)
        yield group, shape(mean, factor * (vectors * np.maximum(values, 0)) @ vectors.T + least)


def distance() -> Column:
    """Squared Mahalanobis distance of the columns ``NAMES`` under the list ``shape``."""
    off = [F.col(name) - F.col("shape")[i] for i, name in enumerate(NAMES)]
    terms = [off[i] * off[j] * F.col("shape")[SIZE + SIZE * i + j] * (1 if i == j else 2) for i, j in PAIRS]
    return sum(terms[1:], terms[0])


def central_shapes(vectors: DataFrame, steps: int) -> DataFrame:
    """``group`` and ``shape`` for each ``group`` of ``vectors`` (columns ``NAMES``)."""
    ranked = vectors.select("group", F.posexplode(F.array(*[F.round(F.col(n) * GRID / s).cast("long") for n, s in LEAST_SPREAD.items()])).alias("item", "class"))
    per_class = ranked.groupBy("group", "item", "class").agg(F.count(F.lit(1)).alias("n"))
    upward = Window.partitionBy("group", "item").orderBy("class")  # classes of one statistic: some thousand at most
    share = per_class.select("group", "item", "class", (F.sum("n").over(upward) / F.sum("n").over(Window.partitionBy("group", "item"))).alias("share"))
    edges = share.groupBy("group", "item").agg(*[F.min(F.when(F.col("share") >= q, F.col("class"))).alias(f"q{q}") for q in (0.25, 0.5, 0.75)])
    listed = edges.groupBy("group").agg(F.collect_list(F.array("item", *[F.col(f"`q{q}`") for q in (0.25, 0.5, 0.75)])).alias("edges"))
    shapes = stage(map_rows(listed, ["group", "edges"], _start, "group string, shape array<double>"), "shapes")
    # Spread of the nearest share of a normal distribution, against that of all of it.
    factor = KEEP / chi_square(chi_square_edge(KEEP, SIZE), SIZE + 2)
    sums = [F.sum(n).alias(f"s_{i}") for i, n in enumerate(NAMES)] + [F.sum(F.col(NAMES[i]) * F.col(NAMES[j])).alias(f"s_{i}_{j}") for i, j in PAIRS]
    named = ["n", *[f"s_{i}" for i in range(SIZE)], *[f"s_{i}_{j}" for i, j in PAIRS]]
    for _ in range(steps):
        classed = vectors.join(shapes, "group").withColumn("class", F.floor(F.log(distance() + 1e-9) * CLASSES))
        per_class = classed.groupBy("group", "class").agg(F.count(F.lit(1)).alias("n"), *sums)
        upward = Window.partitionBy("group").orderBy("class")  # distance classes: some thousand at most
        before = F.sum("n").over(upward) - F.col("n")
        near = per_class.select("*", before.alias("before"), F.sum("n").over(Window.partitionBy("group")).alias("all")).filter(F.col("before") < KEEP * F.col("all"))
        total = near.groupBy("group").agg(*[F.sum(c).alias(c) for c in named])
        shapes = stage(map_rows(total, ["group", *named], partial(_fit, factor=factor), "group string, shape array<double>"), "shapes")
    return shapes


def quality_rules(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    lang_column: str = "lang",
    source_column: str = "source",
    steps: int = 4,
    least_rows: int = 50,
    reject_share: float = 1e-4,
) -> DataFrame:
    """``doc_id``, ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines``, ``n_repeat_words``, ``base_failed``,
    ``kept`` and ``distance`` (squared Mahalanobis; null if ``base_failed``) for every row.

    ``base_failed``: fewer than 50 words, or over half of the words in repeated three-word windows. Of the others, a text
    is kept if its distance is within the point that a normal distribution passes with ``reject_share``. Estimates
    are per language and source over all rows that pass the base rules; groups below ``least_rows`` rows use an estimate
    over all rows. Sums are in floating point, so distances agree to about ten digits between runs.

    Null and blank texts have no words and fail the base rule. Null languages and sources are groups of their own. Repeated
    rows give repeated results. Other columns are not read. No rows give no rows.
    """
    kind = docs.schema[id_column].dataType.simpleString()
    group = F.to_json(F.struct(F.col(lang_column).cast("string").alias("lang"), F.col(source_column).cast("string").alias("source")))
    given = docs.select(F.col(id_column).alias("doc_id"), group.alias("group"), F.col(text_column).alias("text"))
    schema = f"doc_id {kind}, group string, n_words long, word_chars long, n_symbols long, n_lines long, n_dup_lines long, n_repeat_words long"
    counted = map_rows(given, ["doc_id", "group", "text"], _counts, schema)
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    every = stage(counted.withColumn("base_failed", failed), "text-counts")
    vector = {
        "words": F.log1p("n_words"),
        "length": F.log(F.col("word_chars") / F.col("n_words")),
        "symbols": F.log1p(F.col("n_symbols") / F.col("n_words")),
        "lines": F.col("n_dup_lines") / F.greatest("n_lines", F.lit(1)),
        "repeats": F.col("n_repeat_words") / F.col("n_words"),
    }
    passed = every.filter(~F.col("base_failed")).withColumns(vector)
    shapes = central_shapes(passed.select(F.explode(F.array("group", F.lit(POOLED))).alias("group"), *NAMES), steps)
    sizes = passed.groupBy("group").agg(F.count(F.lit(1)).alias("rows"))
    chosen = stage(sizes.select("group", F.when(F.col("rows") >= least_rows, F.col("group")).otherwise(F.lit(POOLED)).alias("used")), "shape-groups")
    fitting = stage(chosen.join(shapes.withColumnRenamed("group", "used"), "used").select("group", "shape"), "shapes-used")
    edge = chi_square_edge(1 - reject_share, SIZE)
    judged = passed.join(fitting, "group").withColumn("distance", distance()).withColumn("kept", F.col("distance") <= edge)
    out = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "distance"]
    rest = every.filter("base_failed").withColumns({"kept": F.lit(False), "distance": F.lit(None).cast("double")})
    return judged.select(*out).unionByName(rest.select(*out))
