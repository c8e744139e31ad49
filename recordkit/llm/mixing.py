"""Mixing to target weights with soft membership: a classifier learned from the labelled table gives each document a
posterior over domains, and projected-gradient least squares fits document rates to the wanted token totals.

A document's posterior depends on its classes of a few statistics only, and the step of a rate on the posterior, so documents of equal classes
keep equal rates. Tokens are summed per vector of classes once, and each iteration sums over these cells; posteriors stay exact.
"""

from __future__ import annotations

import json
import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from recordkit.sources.tables import stage

# Labelled texts, in expectation, from which a domain's words are drawn, and words per domain at most.
SAMPLE, WORDS = 6_000, 200
LEAST_TEXTS, LEAST_LIFT = 4, 3.0
# Classes of each statistic.
CLASSES = 8
NOT_LETTERS, NOT_SPACE = r"[^\p{L}]+", r"[^\x20\x09-\x0D]+"


@dataclass(frozen=True)
class Classifier:
    """Naive Bayes over classes of statistics: domains, words of each, log priors, and log shares by feature, class, domain."""

    domains: list[str]
    words: list[list[str]]
    priors: list[float]
    shares: list[list[list[float]]]


def letters(text: Column) -> Column:
    return F.split(F.lower(F.coalesce(text, F.lit(""))), NOT_LETTERS)


def statistics(text: Column, words: list[list[str]]) -> dict[str, Column]:
    """``n_tokens`` and one class column per feature, from the whole text."""
    given = F.coalesce(text, F.lit(""))
    tokens = F.regexp_count(given, F.lit(NOT_SPACE)).cast("long")
    size = F.greatest(tokens, F.lit(1))
    symbols = F.regexp_count(given, F.lit(r"[#*$%&|<>!]"))
    capitals = F.regexp_count(given, F.lit(r"\p{Lu}"))
    every = sorted({w for own in words for w in own})
    held = F.array_intersect(letters(text), F.array(*[F.lit(w) for w in every]).cast("array<string>"))
    columns = {
        "n_tokens": tokens,
        "length": F.least(F.floor(F.log10(1 + tokens) * 2), F.lit(CLASSES - 1)),
        "symbols": F.least(F.floor(F.log2(1 + 32 * symbols / size)), F.lit(CLASSES - 1)),
        "capitals": F.least(F.floor(F.log2(1 + 8 * capitals / size)), F.lit(CLASSES - 1)),
        "held": held,
    }
    for k, own in enumerate(words):
        columns[f"words_{k}"] = F.least(F.size(F.array_intersect("held", F.array(*[F.lit(w) for w in own]).cast("array<string>"))), F.lit(CLASSES - 1))
    return columns


def feature_names(domains: list[str]) -> list[str]:
    return ["length", "symbols", "capitals", *[f"words_{k}" for k in range(len(domains))]]


def domain_words(docs: DataFrame, told: DataFrame, domains: list[str]) -> list[list[str]]:
    """For each domain the words that most mark it, from about ``SAMPLE`` labelled texts of one half of the labelled rows."""
    rows = told.count()
    place = F.xxhash64(F.lit("words"), F.col("id").cast("string")).cast("double") / 2.0**64 + 0.5
    drawn = told.filter(place <= min(0.5, SAMPLE / max(rows, 1)))  # about SAMPLE ids, so they may go to every task
    texts = docs.join(F.broadcast(drawn), "id").select("domain", F.explode(F.array_distinct(letters(F.col("text")))).alias("word")).filter("word != ''")
    counts = texts.groupBy("word").pivot("domain", domains).agg(F.count(F.lit(1))).na.fill(0)
    totals = {r["domain"]: r["n"] for r in drawn.groupBy("domain").agg(F.count(F.lit(1)).alias("n")).collect()}
    out = []
    for domain in domains:
        own, inside = F.col(f"`{domain}`"), totals.get(domain, 0)
        others = sum((F.col(f"`{d}`") for d in domains if d != domain), F.lit(0))
        outside = sum(totals.values()) - inside
        lift = (own / max(inside, 1)) / ((others + 1) / (outside + 1))
        best = counts.filter((own >= LEAST_TEXTS) & (lift >= LEAST_LIFT)).orderBy(F.desc(own * F.log(lift)), "word").limit(WORDS)
        out.append([r["word"] for r in best.select("word").collect()])
    return out


def fit_classifier(docs: DataFrame, told: DataFrame, domains: list[str]) -> tuple[Classifier, DataFrame]:
    """The classifier, and the statistics of every document, written. ``docs``: id, text; ``told``: id, domain (once per id).

    Words come from one half of the labelled rows, shares of classes from all rows of the other half.
    """
    words = domain_words(docs, told, domains)
    measured = docs
    for name, column in statistics(F.col("text"), words).items():
        measured = measured.withColumn(name, column)
    names = feature_names(domains)
    measured = stage(measured.select("id", "n_tokens", *[F.col(n).cast("int").alias(n) for n in names]), "domain-statistics")
    place = F.xxhash64(F.lit("words"), F.col("id").cast("string")).cast("double") / 2.0**64 + 0.5
    sums = [F.sum((F.col(n) == c).cast("long")).alias(f"{n}_{c}") for n in names for c in range(CLASSES)]
    counted = {r["domain"]: r for r in measured.join(told.filter(place > 0.5), "id").groupBy("domain").agg(F.count(F.lit(1)).alias("n"), *sums).collect()}
    rows = [counted[d]["n"] if d in counted else 0 for d in domains]
    priors = [math.log((n + 1) / (sum(rows) + len(domains))) for n in rows]
    held = [[[counted[d][f"{n}_{c}"] if d in counted else 0 for d in domains] for c in range(CLASSES)] for n in names]
    shares = [[[math.log((n + 1) / (rows[k] + CLASSES)) for k, n in enumerate(one)] for one in feature] for feature in held]
    return Classifier(domains, words, priors, shares), measured


def posterior(model: Classifier) -> Column:
    """Probabilities of the domains, as an array."""
    logs = []
    for k in range(len(model.domains)):
        terms = [F.array(*[F.lit(c[k]) for c in feature])[F.col(n)] for n, feature in zip(feature_names(model.domains), model.shares)]
        logs.append(sum(terms, F.lit(model.priors[k])))
    log = F.array(*logs)
    raised = F.transform(log, lambda x: F.exp(x - F.array_max(log)))
    total = F.aggregate(raised, F.lit(0.0), lambda a, x: a + x)
    return F.transform(raised, lambda x: x / total)


def rate(steps: list[list[float]], most: float | None, ahead: bool = False) -> Column:
    """The rate after ``steps`` for the column ``shares``, from one on; ``ahead``: the point at which the next residuals are
    taken. A step holds the weighted residual per domain, then how far to run on in the direction of the last step."""
    if not steps:
        return F.lit(1.0)
    k = len(steps[0]) - 1

    def step(now: Column, e: Column) -> Column:
        down = sum((F.col("shares")[i] * e[i] for i in range(1, k)), F.col("shares")[0] * e[0])
        new = F.greatest(now["ahead"] - down, F.lit(0.0))
        new = new if most is None else F.least(new, F.lit(float(most)))
        return F.struct(new.alias("rate"), (new + e[k] * (new - now["rate"])).alias("ahead"))

    listed = F.from_json(F.lit(json.dumps(steps)), "array<array<double>>")  # one constant, however many steps
    return F.aggregate(listed, F.struct(F.lit(1.0).alias("rate"), F.lit(1.0).alias("ahead")), step)["ahead" if ahead else "rate"]


def fit_rates(cells: DataFrame, domains: list[str], weights: dict[str, float], total: float | None, most: float | None, rounds: int, close: float, whole: str | None = None) -> list[list[float]]:
    """Steps for ``rate``. ``cells``: ``shares`` and ``n_tokens``, one row per vector of classes.

    Accelerated projected gradient on least squares over domains, each weighted by the inverse of its share of tokens:
    with that weight the gradient's largest eigenvalue is one, so a step of one descends. Ends when every total is
    within ``close`` of the target (relative to the sum of targets), when ten steps have gained under a hundredth, as with
    targets out of reach, or after ``rounds`` steps.
    """

    def totals(steps: list[list[float]]) -> tuple[list[float], list[float]]:
        sums = [F.sum(rate(steps, most, ahead) * F.col("n_tokens") * F.col("shares")[i]) for ahead in (False, True) for i in range(len(domains))]
        found = [float(x or 0) for x in cells.agg(*sums).first()]
        return found[: len(domains)], found[len(domains) :]

    now, ahead = totals([])
    before, every = now, sum(now)
    if not every:
        return []
    share = sum(weights[d] for d in domains)
    wanted = [weights[d] / share for d in domains]
    if total is None and whole is not None:  # what leaves this domain at rate one
        total = next((n / w for d, n, w in zip(domains, now, wanted) if d == whole and w and n), None)
    if total is None:  # all tokens; under a highest rate, what the scarcest domain allows
        total = every if most is None else min([most * n / w for n, w in zip(now, wanted) if w and n], default=every)
    steps: list[list[float]] = []
    worst: list[float] = []
    for n in range(rounds):
        worst.append(max(abs(x - total * w) for x, w in zip(now, wanted)) / total)
        if worst[-1] <= close or (n >= 20 and min(worst[-10:]) > 0.99 * min(worst[:-10])):
            break
        steps.append([*[(x - total * w) / first if first else 0.0 for x, w, first in zip(ahead, wanted, before)], n / (n + 3)])
        now, ahead = totals(steps)
    return steps


def mix(
    docs: DataFrame,
    labels: DataFrame,
    domain: Column,
    weights: dict[str, float],
    id_column: str = "doc_id",
    text_column: str = "text",
    total: float | None = None,
    most: float | None = None,
    rounds: int = 60,
    close: float = 1e-3,
    whole: str | None = None,
) -> DataFrame:
    """``doc_id``, ``n_tokens``, ``domain`` (likeliest), ``p_<domain>`` and ``rate`` (0 or more) for every row.

    ``domain`` is an expression on ``labels`` that names one of the domains of ``weights``, or null for no label; an id
    labelled twice takes the smallest name. Rates start at one and go no further than the targets need, so that the sum
    of rate times tokens times posterior over all rows comes to ``total`` times the domain's weight (``total`` None: as many tokens
    as now, or with a highest rate ``most``, as many as the scarcest domain allows; with ``whole``, as many as leave that domain
    as it is, so that a scarce one falls short of its weight instead of taking others with it). A domain nobody is likely to be in
    stays short. Tokens are words between ASCII white space.

    Null and empty texts have no tokens, and a posterior and a rate like others. Without labels all domains are equally
    likely. Repeated rows count and return each; null ids have no label. Other columns are not read. No rows give no rows.
    """
    domains = sorted(weights)
    given = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    told = labels.select(F.col(id_column).alias("id"), domain.alias("domain")).filter(F.col("domain").isin(domains) & F.col("id").isNotNull())
    told = stage(told.groupBy("id").agg(F.min("domain").alias("domain")), "domain-labels")
    model, measured = fit_classifier(given, told, domains)
    # Written, so that no later filter takes the whole posterior into each step of a rate.
    placed = stage(measured.withColumn("shares", posterior(model)), "domain-posteriors")
    # At most CLASSES to the power of the features, whatever the number of documents; far fewer occur.
    names = feature_names(domains)
    cells = measured.groupBy(*names).agg(F.sum("n_tokens").alias("n_tokens"))
    cells = stage(cells.select("n_tokens", posterior(model).alias("shares")), "domain-cells")
    steps = fit_rates(cells, domains, weights, total, most, rounds, close, whole)
    likeliest = F.array(*[F.lit(d) for d in domains])[F.array_position("shares", F.array_max("shares")).cast("int") - 1]
    shown = [F.col("shares")[k].alias(f"p_{d}") for k, d in enumerate(domains)]
    return placed.select(F.col("id").alias("doc_id"), "n_tokens", likeliest.alias("domain"), *shown, rate(steps, most).alias("rate"))
