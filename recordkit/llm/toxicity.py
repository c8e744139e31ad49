"""Toxicity by non-negative positive-unlabelled learning: confirmed toxic texts against texts of unknown kind.

A linear score over presence of word starts is trained in numpy on a bounded sample; its risk is corrected by the share of
toxic texts, and its negative part may not fall below zero. All texts are then scored whole.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from recordkit.llm.common import held_out, map_rows
from recordkit.sources.tables import stage

# Texts in the training sample, in expectation: confirmed toxic ones, and ones of unknown kind.
POSITIVE, UNLABELLED = 3_000, 12_000
# Word starts that are looked at in the unlabelled sample, and that get a weight, at most.
CANDIDATES, FEATURES = 50_000, 4_096
# A word start is used if this many positive texts have it, this many times as often as others.
LEAST_TEXTS, LEAST_LIFT = 4, 3.0
# Share of toxic texts assumed where the labels hold only one kind.
SHARE = 0.1
# Different texts of one id in the sample, in expectation, where an id stands on very many rows.
PER_ID = 16
# Words whose features a task remembers, and the characters of such a word at most; it forgets them when full.
WORDS, WORD_CHARS = 200_000, 64
LETTERS = re.compile(r"[^\W\d_]+")


@dataclass(frozen=True)
class Model:
    weights: dict[str, float]
    bias: float


def starts(word: str) -> list[str]:
    """The whole word (marked) and its starts of three to six letters."""
    return [word + "$", *(word[:n] for n in range(3, min(6, len(word)) + 1))]


def features(text: str | None) -> set[str]:
    return {s for word in set(LETTERS.findall((text or "").lower())) for s in starts(word)}


def _count(rows: Iterator[tuple], among: frozenset[str] | None) -> Iterator[tuple]:
    """Texts of the partition that have each feature; partial counts go out when many features are held."""
    held: Counter[str] = Counter()
    for (text,) in rows:
        found = features(text)
        held.update(found if among is None else found & among)
        if len(held) > 500_000:
            yield from held.items()
            held.clear()
    yield from held.items()


def _present(rows: Iterator[tuple], chosen: dict[str, int]) -> Iterator[tuple]:
    for kind, text in rows:
        yield kind, sorted(chosen[f] for f in features(text) & chosen.keys())


def _drawn(column: Column, wanted: int, total: int) -> Column:
    """True for about ``wanted`` of ``total`` rows, by a hash of the column."""
    return F.xxhash64(F.lit("draw"), column.cast("string")).cast("double") / 2.0**64 + 0.5 <= min(1.0, wanted / max(total, 1))


def bounded(rows: DataFrame) -> DataFrame:
    """Rows of drawn ids, written: equal rows once, and of an id on many rows about ``PER_ID``, so that no id fills the sample."""
    once = stage(rows.dropDuplicates(["id", "text"]), "drawn-rows")
    often = once.groupBy("id").agg(F.count(F.lit(1)).alias("rows")).filter(F.col("rows") > PER_ID)
    place = F.xxhash64(F.lit("text"), "text").cast("double") / 2.0**64 + 0.5
    kept = once.join(often, "id", "left").filter(F.col("rows").isNull() | (place * F.col("rows") <= PER_ID))
    return stage(kept.select("id", "text"), "sample-rows")


def risk_step(g_p: np.ndarray, g_u: np.ndarray, share: float) -> tuple[np.ndarray, np.ndarray, float]:
    """Gradients of the non-negative risk for the scores of positive and unlabelled texts, and the risk, under sigmoid loss."""
    s_p, s_u = 1 / (1 + np.exp(-g_p)), 1 / (1 + np.exp(-g_u))  # loss as negative; as positive it is one minus this
    positive, negative = share * (1 - s_p).mean(), s_u.mean() - share * s_p.mean()
    slope_p, slope_u = s_p * (1 - s_p) / len(g_p), s_u * (1 - s_u) / len(g_u)
    if negative >= 0:
        return -2 * share * slope_p, slope_u, positive + negative
    return share * slope_p, -slope_u, positive  # the negative part fell below zero: climb back


def train(positive: list[list[int]], unlabelled: list[list[int]], size: int, share: float, steps: int = 400, rate: float = 0.1, decay: float = 1e-4) -> tuple[np.ndarray, float]:
    """Weights and bias by Adam on the non-negative risk."""
    rows, n = positive + unlabelled, len(positive)
    at = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    which = np.concatenate([np.array(r, dtype=np.int64) for r in rows]) if len(at) else np.zeros(0, dtype=np.int64)
    weights = np.zeros(size + 1)
    weights[size] = np.log(share / (1 - share))
    mean, square = np.zeros_like(weights), np.zeros_like(weights)
    for step in range(1, steps + 1):
        g = weights[size] + np.bincount(at, weights=weights[which], minlength=len(rows))
        down_p, down_u, _ = risk_step(g[:n], g[n:], share)
        down = np.concatenate([down_p, down_u])
        gradient = np.append(np.bincount(which, weights=down[at], minlength=size), down.sum()) + decay * weights / len(weights)
        mean, square = 0.9 * mean + 0.1 * gradient, 0.999 * square + 0.001 * gradient**2
        weights -= rate * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
    return weights[:size], float(weights[size])


def fit(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", label_column: str = "toxic") -> Model:
    """A model from rows that are not held out: texts labelled 1, and texts drawn from all rows whatever their label.

    The share of toxic texts is that of all labelled rows. Rows are drawn by a hash of their id, about ``POSITIVE`` and
    ``UNLABELLED`` of them (see ``bounded`` for an id on many rows); the driver gets the numbers of their chosen features only. An id labelled twice counts as toxic
    if one label says so. Without a toxic label the model is empty and scores every text 0.
    """
    told = labels.filter(F.col(label_column).isNotNull() & ~held_out(F.col(id_column))).groupBy(F.col(id_column).alias("id")).agg(F.max(label_column).alias("toxic"))
    seen = told.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum((F.col("toxic") == 1).cast("long")), F.lit(0)).alias("toxic")).first()
    if not seen["toxic"]:
        return Model({}, -np.inf)
    share = seen["toxic"] / seen["n"] if seen["toxic"] < seen["n"] else SHARE
    open_rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text")).filter(~held_out(F.col("id")))
    ids = told.filter((F.col("toxic") == 1) & _drawn(F.col("id"), POSITIVE, seen["toxic"])).select("id")
    positive = bounded(open_rows.join(F.broadcast(ids), "id", "left_semi"))  # about POSITIVE ids
    unlabelled = bounded(open_rows.filter(_drawn(F.col("id"), UNLABELLED, open_rows.select("id").count())))
    often = map_rows(positive, ["text"], partial(_count, among=None), "feature string, n long").groupBy("feature").agg(F.sum("n").alias("n"))
    often = often.filter(F.col("n") >= LEAST_TEXTS).orderBy(F.desc("n"), "feature").limit(CANDIDATES)
    in_positive = {r["feature"]: r["n"] for r in often.collect()}
    counted = map_rows(unlabelled, ["text"], partial(_count, among=frozenset(in_positive)), "feature string, n long")
    in_unlabelled = {r["feature"]: r["n"] for r in counted.groupBy("feature").agg(F.sum("n").alias("n")).collect()}
    n_p, n_u = positive.count(), unlabelled.count()
    if not n_p or not n_u:
        return Model({}, -np.inf)
    lift = {f: (n / n_p) / ((in_unlabelled.get(f, 0) + 1) / (n_u + 1)) for f, n in in_positive.items()}
    ranked = sorted((f for f in lift if lift[f] >= LEAST_LIFT), key=lambda f: (-in_positive[f] * np.log(lift[f]), f))[:FEATURES]
    chosen = {f: i for i, f in enumerate(ranked)}
    sample = positive.select(F.lit(1).alias("kind"), "text").unionByName(unlabelled.select(F.lit(0).alias("kind"), "text"))
    rows = map_rows(sample, ["kind", "text"], partial(_present, chosen=chosen), "kind int, found array<int>").collect()
    rows = sorted((r["kind"], list(r["found"])) for r in rows)
    weights, bias = train([f for k, f in rows if k == 1], [f for k, f in rows if k == 0], len(chosen), share)
    return Model({f: float(weights[i]) for f, i in chosen.items()}, bias)


def _score(rows: Iterator[tuple], model: Model) -> Iterator[tuple]:
    weights, known = model.weights, {}
    for doc_id, out, text in rows:
        if len(known) > WORDS:
            known.clear()
        found: set[str] = set()
        for word in set(LETTERS.findall((text or "").lower())):
            own = known.get(word)
            if own is None:
                own = tuple(s for s in starts(word) if s in weights)
                if len(word) <= WORD_CHARS:
                    known[word] = own
            if own:
                found.update(own)
        total = model.bias + sum(weights[f] for f in sorted(found))
        score = float(1 / (1 + np.exp(-np.clip(total, -500, 500)))) if np.isfinite(total) else 0.0
        yield doc_id, out, score, int(score >= 0.5)


def score(docs: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` (0 to 1) and ``predicted`` for every row, from its whole text alone.

    A text without words (null, empty) scores what the bias gives. Rows with a null id count as held out and are scored
    like any other. Repeated rows give repeated results; other columns are not read. No rows give no rows.
    """
    kind = docs.schema[id_column].dataType.simpleString()
    given = docs.select(F.col(id_column).alias("doc_id"), held_out(F.col(id_column)).alias("held_out"), F.col(text_column).alias("text"))
    return map_rows(given, ["doc_id", "held_out", "text"], partial(_score, model=model), f"doc_id {kind}, held_out boolean, score double, predicted int")
