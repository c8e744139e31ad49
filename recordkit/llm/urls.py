"""URL filter: rules on host and path, and for all other URLs the ratio of two character language models.

The models are smoothed Markov models of variable order, one for accepted and one for rejected URLs. A URL is accepted
if the difference of its two log-likelihoods per character reaches a point calibrated on URLs kept out of training.
"""

from __future__ import annotations

import math
import string
from itertools import groupby
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from recordkit.llm.common import map_rows
from recordkit.sources.tables import stage

# Rules on host and path: fixed values.
RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/")]
ORDER = 5
# Rows that are scored together: a power of two.
BLOCK_BITS = 12
START, END = "\x02", "\x03"
# Share of a character that no training URL has.
UNSEEN = 1 / 256
# Differences are calibrated in classes of a thousandth, within these bounds.
CLASSES, BOUND = 1_000, 20


def host_and_path(url: Column) -> tuple[Column, Column]:
    given = F.coalesce(url, F.lit(""))
    host = F.translate(F.regexp_extract(given, r"(?s)^.*?://([^/?#]*)", 1), string.ascii_uppercase, string.ascii_lowercase)
    return host, F.regexp_extract(given, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; null without one."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, rule in sorted(rules, key=lambda r: len(r[1])):
        top, slash, rest = rule.partition("/")
        fits = ((host == top) | host.endswith(f".{top}")) & path.startswith(slash + rest)
        name, verdict = F.when(fits, F.lit(rule)).otherwise(name), F.when(fits, F.lit(kind)).otherwise(verdict)
    return name, verdict


def _sequences(rows: Iterator[tuple]) -> Iterator[tuple]:
    held: Counter[tuple[str, str]] = Counter()
    for verdict, url in rows:
        text = START + url + END
        for end in range(1, len(text)):
            held.update((verdict, text[start : end + 1]) for start in range(max(0, end - ORDER), end + 1))
        if len(held) > 200_000:
            yield from ((*key, n) for key, n in held.items())
            held.clear()
    yield from ((*key, n) for key, n in held.items())


@dataclass(frozen=True)
class Markov:
    """Counts of sequences, and for each context how often and before how many characters it stands."""

    counts: dict[str, int]
    seen: dict[str, int]
    kinds: dict[str, int]

    @staticmethod
    def of(counts: dict[str, int]) -> Markov:
        seen: Counter[str] = Counter()
        kinds: Counter[str] = Counter()
        for sequence, n in counts.items():
            seen[sequence[:-1]] += n
            kinds[sequence[:-1]] += 1
        return Markov(counts, dict(seen), dict(kinds))

    def log_likelihood(self, url: str) -> float:
        """Each character's share is that after the longest known context, mixed with those after shorter ones by the
        number of kinds that followed (Witten and Bell)."""
        text, total = START + url + END, 0.0
        counts, seen, kinds = self.counts, self.seen, self.kinds
        for end in range(1, len(text)):
            share, next_one = UNSEEN, text[end]
            for start in range(end, max(-1, end - ORDER - 1), -1):
                context = text[start:end]
                n = seen.get(context)
                if n is None:
                    break
                k = kinds[context]
                share = (counts.get(context + next_one, 0) + k * share) / (n + k)
            total += math.log(share)
        return total


@dataclass(frozen=True)
class UrlModel:
    """Written tables: how often each sequence stands in URLs of either verdict (``n_allow``, ``n_block``), and each context
    (``seen_``) before how many characters (``kinds_``). From ``edge`` on a URL is accepted."""

    counts: DataFrame
    contexts: DataFrame
    edge: float


def top_sequences(url: str) -> list[str]:
    """Each character with its context."""
    text = START + url + END
    return [text[max(0, end - ORDER) : end + 1] for end in range(1, len(text))]


def _top_sequences(rows: Iterator[tuple]) -> Iterator[tuple]:
    for block, own in groupby(rows, itemgetter(0)):
        held: set[str] = set()
        for _, url in own:
            held.update(top_sequences(url))
            if len(held) > 200_000:
                yield from ((block, s) for s in held)
                held.clear()
        yield from ((block, s) for s in held)


def share_tables(wanted: DataFrame, model: UrlModel) -> list[DataFrame]:
    """Shares of the last character of each ``sequence`` by both models, by length of the sequence: as in ``Markov``, each
    length from the one before. A table for each length, written."""
    lengths = F.sequence(F.lit(1), F.length("sequence"))
    ends = wanted.select(F.explode(F.transform(lengths, lambda n: F.expr("sequence").substr(F.length("sequence") - n + 1, n))).alias("sequence")).distinct()
    ends = ends.join(model.counts, "sequence", "left").withColumn("context", F.expr("left(sequence, length(sequence) - 1)"))
    known = stage(ends.join(model.contexts, "context", "left").drop("context"), "url-wanted")
    out: list[DataFrame] = []
    for length in range(1, ORDER + 2):
        own = known.filter(F.length("sequence") == length)
        if out:
            shorter = out[-1].withColumnRenamed("sequence", "shorter")
            own = own.withColumn("shorter", F.expr("substring(sequence, 2)")).join(shorter, "shorter")
        else:
            own = own.withColumns({"share_allow": F.lit(UNSEEN), "share_block": F.lit(UNSEEN)})
        shares = []
        for verdict in ("allow", "block"):
            n, seen, kinds = (F.coalesce(f"{name}_{verdict}", F.lit(0)) for name in ("n", "seen", "kinds"))
            before = F.col(f"share_{verdict}")
            shares.append(F.when(seen > 0, (n + kinds * before) / (seen + kinds)).otherwise(before).alias(f"share_{verdict}"))
        out.append(stage(own.select("sequence", *shares), "url-shares"))
    return out


def with_difference(rows: DataFrame, model: UrlModel) -> DataFrame:
    """``rows`` with ``difference`` (log-likelihood per character, accepted less rejected) in place of ``url``.

    Rows are dealt into blocks of at most ``2 ** BLOCK_BITS``; each looks up the different sequences of its URLs alone.
    """
    block = F.shiftright(F.monotonically_increasing_id(), BLOCK_BITS)
    # Written, since a task that runs again may number other rows.
    dealt = stage(rows.withColumn("url", F.coalesce("url", F.lit(""))).withColumn("block", block), "url-blocks")
    wanted = stage(map_rows(dealt, ["block", "url"], _top_sequences, "block long, sequence string").distinct(), "url-sequences-wanted")
    tables = share_tables(wanted.select("sequence").distinct(), model)
    shares = tables[0]
    for one in tables[1:]:
        shares = shares.unionByName(one)
    found = wanted.join(shares, "sequence").select("block", "sequence", (F.log("share_allow") - F.log("share_block")).alias("step"))
    kept = [c for c in rows.columns if c != "url"]

    def scored(left: pa.Table, right: pa.Table) -> pa.Table:
        step = dict(zip(right.column("sequence").to_pylist(), right.column("step").to_pylist()))
        urls = left.column("url").to_pylist()
        differences = [sum(step[s] for s in top_sequences(url)) / (len(url) + 1) for url in urls]
        return left.select(kept).append_column("difference", pa.array(differences, pa.float64()))

    schema = dealt.select(*kept, F.lit(0.0).alias("difference")).schema
    return dealt.groupBy("block").cogroup(found.groupBy("block")).applyInArrow(scored, schema)


def best_edge(classes: list[tuple[str, int, int]]) -> float:
    """The point with the best mean of the shares of accepted URLs at or above it and rejected ones below: the middle
    between two classes that hold URLs, of equals the lowest. ``classes``: verdict, class and number of URLs."""
    total = Counter()
    for verdict, _, n in classes:
        total[verdict] += n
    if not total["allow"] or not total["block"]:
        return 0.0
    by_class: dict[int, Counter] = {}
    for verdict, at, n in classes:
        by_class.setdefault(at, Counter())[verdict] += n
    best, edge, above, below, last = -1.0, 0.0, total["allow"], 0, min(by_class) - 1
    for at in [*sorted(by_class), max(by_class) + 1]:
        if (worth := above / total["allow"] + below / total["block"]) > best + 1e-12:
            best, edge = worth, (last + 1 + at) / 2 / CLASSES
        here = by_class.get(at, Counter())
        above, below, last = above - here["allow"], below + here["block"], at
    return edge


def judged_by_rules(pages: DataFrame, id_column: str, url_column: str, rules: list[tuple[str, str]]) -> DataFrame:
    host, path = host_and_path(F.col(url_column))
    split = pages.select(F.col(id_column).alias("page_id"), F.col(url_column).alias("url"), host.alias("host"), path.alias("path"))
    name, verdict = rule_of(F.col("host"), F.col("path"), rules)
    return split.withColumns({"rule": name, "told": verdict})


def fit_urls(pages: DataFrame, rules: list[tuple[str, str]] = RULES, id_column: str = "page_id", url_column: str = "url") -> UrlModel | None:
    """Models of the URLs that rules allow and block; None if one kind is missing.

    Different URLs are dealt by a hash: one in five calibrates, all others train, whole and however many they are. Counts stay in
    written tables; the driver gets one count per class of differences.
    """
    told = judged_by_rules(pages, id_column, url_column, rules).filter("told is not null").select("told", "url")
    # Copies of a URL hash alike, so they are either all drawn or none, and count once.
    place = F.xxhash64("url").cast("double") / 2.0**64 + 0.5
    if {r["told"] for r in told.select("told").distinct().collect()} != {"allow", "block"}:
        return None
    once = told.filter(place <= 0.8).distinct()
    sequences = map_rows(once, ["told", "url"], _sequences, "told string, sequence string, n long")
    sums = [F.coalesce(F.sum(F.when(F.col("told") == v, F.col("n"))), F.lit(0)).alias(f"n_{v}") for v in ("allow", "block")]
    counts = stage(sequences.groupBy("sequence").agg(*sums), "url-sequences")
    context = F.expr("left(sequence, length(sequence) - 1)").alias("context")
    held = [x for v in ("allow", "block") for x in (F.sum(f"n_{v}").alias(f"seen_{v}"), F.count_if(F.col(f"n_{v}") > 0).alias(f"kinds_{v}"))]
    contexts = stage(counts.groupBy(context).agg(*held), "url-contexts")
    model = UrlModel(counts, contexts, 0.0)
    test = with_difference(told.filter(place > 0.8).distinct(), model)
    at = F.least(F.greatest(F.floor(F.col("difference") * CLASSES), F.lit(-BOUND * CLASSES)), F.lit(BOUND * CLASSES))
    classes = test.groupBy("told", at.alias("class")).agg(F.count(F.lit(1)).alias("n")).collect()
    return UrlModel(counts, contexts, best_edge([(r["told"], r["class"], r["n"]) for r in classes]))


def filter_urls(pages: DataFrame, model: UrlModel | None, rules: list[tuple[str, str]] = RULES, id_column: str = "page_id", url_column: str = "url") -> DataFrame:
    """``page_id``, ``host``, ``path``, ``rule``, ``verdict`` and ``difference`` (log-likelihood per character, accepted less
    rejected) for every row.

    The longest rule that fits decides; without one, ``difference`` at the calibrated point or above is ``allow``. A null
    URL is judged like an empty one and has no host and path; a URL without ``://`` has neither, but is judged by its
    characters. Without a model (no URL of one kind to learn from) the difference is null and such URLs are allowed.
    Repeated rows give repeated results; other columns are not read. No rows give no rows.
    """
    told = judged_by_rules(pages, id_column, url_column, rules)
    kept = ["page_id", "host", "path", "rule", "told"]
    if model is None:
        judged, own = told.withColumn("difference", F.lit(None).cast("double")), F.lit("allow")
    else:
        judged = with_difference(told.select(*kept, "url"), model)
        own = F.when(F.col("difference") >= model.edge, F.lit("allow")).otherwise(F.lit("block"))
    return judged.select("page_id", "host", "path", "rule", F.coalesce("told", own).alias("verdict"), "difference")
