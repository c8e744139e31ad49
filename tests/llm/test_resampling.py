"""Importance resampling against plain Python, and the bracket that holds the cutoff."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter
from fractions import Fraction

import pytest
from helpers import bag, rows
from pyspark.sql import functions as F

from recordkit.llm import resampling
from recordkit.llm.common import numbered

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def buckets(text: str | None) -> tuple[int, list[int]]:
    words = WORD.findall((text or "").encode().lower())
    runs = words + [a + b" " + b for a, b in zip(words, words[1:])]
    return len(words), [zlib.crc32(r) % 10_000 for r in runs]


def expected(docs: list[tuple], target: list[str | None], percent: int = 25, least: int = 20) -> list[tuple]:
    found = [buckets(t) for _, t in docs]
    own, wanted = Counter(b for _, bs in found for b in bs), Counter(b for t in target for b in buckets(t)[1])
    s, t = sum(own.values()), sum(wanted.values())
    out = []
    for (i, _), (n_words, bs) in zip(docs, found):
        gain = [math.floor(1000 * math.log(float((wanted[b] + 1) * (s + 10_000)) / float((own[b] + 1) * (t + 10_000)))) for b in bs]
        weight = math.floor(Fraction(sum(gain), len(gain))) if gain else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append((i, len(bs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n_words))
    fit = sorted((r for r in out if r[4] >= least), key=lambda r: (-r[3], r[0] is not None, r[0] or 0, r[1]))
    drawn = Counter({})
    for place, r in enumerate(fit[: len(fit) * percent // 100], 1):
        drawn[(*r[:4], place)] += 1
    left = Counter(r[:4] for r in out)
    left.subtract(Counter(k[:4] for k in drawn.elements()))
    return drawn + Counter({(*k, None): n for k, n in left.items() if n > 0})


def texts(n: int, seed: int) -> list[str]:
    dice = random.Random(seed)
    words = ["".join(dice.choices("abcdefgé7", k=dice.randint(1, 6))) for _ in range(300)]
    return [dice.choice([" ", ", ", "-\n"]).join(dice.choices(words, k=dice.randint(15, 60))) for _ in range(n)]


ODD = [(None, None), (-4, ""), (-3, " .,\x00"), (-2, "ABC abc " * 20), (-1, "İ ß ſ K kelvin\x7fK " * 9), (None, "one two " * 30)]


def test_against_plain_python(spark):
    docs = [*enumerate(texts(300, 1)), *ODD]
    docs += [docs[5]] * 40  # an id and text on many rows
    target = [*texts(40, 2), None, ""]
    frame = spark.createDataFrame([(i, t, 1, 2, 3) for i, t in docs], "doc_id long, text string, rank int, score int, row int").repartition(5)
    got = resampling.resample(frame, spark.createDataFrame([(1, t) for t in target], "item_id long, text string"))
    assert got.dtypes == [(c, "bigint") for c in ("doc_id", "n_features", "weight", "score", "rank")]
    assert bag(got) == expected(docs, target)


@pytest.mark.parametrize("percent", [0, 1, 100])
def test_shares_and_missing_tables(spark, percent):
    docs = list(enumerate(texts(30, 3)))
    frame, none = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([], "item_id long, text string")
    assert bag(resampling.resample(frame, none, percent=percent)) == expected(docs, [], percent)
    assert rows(resampling.resample(frame.limit(0), none, percent=percent)) == []


def test_long_texts_are_split_in_blocks(monkeypatch):
    for text in ["a bc " * 50 + "d", "x" * 100, "", "  a", "Word, word;é " * 11]:
        for size in (1, 7, 64, 1 << 20):
            monkeypatch.setattr(resampling, "BLOCK", size)
            n, found = resampling.feature_buckets(text.encode(), {}, 10_000)
            want = buckets(text)
            assert (n, Counter(found.tolist())) == (want[0], Counter(want[1]))


def test_many_words_and_long_words_are_not_all_kept(monkeypatch):
    monkeypatch.setattr(resampling, "WORDS", 3)
    known: dict = {}
    text = "a b c d e f " + "y" * 100 + " a b"
    n, found = resampling.feature_buckets(text.encode(), known, 10_000)
    assert (n, Counter(found.tolist())) == (9, Counter(buckets(text)[1])) and len(known) <= 3 and b"y" * 100 not in known


def test_bracket_is_widened_until_it_holds_the_cutoff(spark):
    dice = random.Random(4)
    values = [dice.randint(-5_000, 5_000) for _ in range(5_000)] + [77] * 3_000  # many rows of one score
    frame = spark.createDataFrame([(v,) for v in values], "score long").repartition(6)
    ranked = sorted(values, reverse=True)
    for wanted in (1, 17, 2_000, 4_000, 7_999, 8_000):
        for size, near in ((8, 1e-6), (2_048, 0.002)):
            low, high, above = resampling.bracket(frame, wanted, len(values), size, near)
            assert low <= ranked[wanted - 1] <= high and above == sum(v > high for v in values)


def test_numbers_follow_the_order_over_many_ranges(spark, partitions):
    partitions(7)
    frame = spark.range(2_000).select((F.col("id") % 5).alias("key"), "id").repartition(4)
    got = numbered(frame, [F.desc("key"), F.asc("id")], "place").collect()
    assert [(r["key"], r["id"]) for r in sorted(got, key=lambda r: r["place"])] == sorted(((i % 5, i) for i in range(2_000)), key=lambda x: (-x[0], x[1]))
    assert sorted(r["place"] for r in got) == list(range(1, 2_001))
