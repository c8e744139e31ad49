"""Exact and near dedup against plain Python on small, awkward tables."""

from __future__ import annotations

import hashlib
import random
from itertools import combinations

import pytest
import xxhash
from helpers import bag, by_key, rows

from recordkit.llm import exact_dedup, simhash
from recordkit.llm.components import components

SCHEMA = "doc_id long, text string, recipe string, kept boolean"


def plain_groups(data):
    same: dict[str, list] = {}
    for doc_id, text, *_ in data:
        same.setdefault(text or "", []).append(doc_id)
    out = []
    for text, ids in same.items():
        known = [i for i in ids if i is not None]
        keep = max(known) if known else None
        stays = False
        for i in ids:
            kept = i == keep and not stays
            stays = stays or kept
            out.append((i, keep, len(ids), kept, hashlib.sha256(text.encode()).hexdigest()))
    return out


def awkward():
    dice = random.Random(4)
    long = "".join(dice.choices("abc def\n", k=60_000))
    texts = ["a b", "a b", "a  b", None, "", " ", "é", "é", long, long, long + ".", "." + long, "x" * 70_000, "x" * 70_000, "x" * 70_001]
    data = [(i, t, "z", True) for i, t in enumerate(texts)]
    return data + [(0, "a b", "y", False), (None, "a b", None, None), (None, "alone", None, None), (None, "alone", None, None)]


@pytest.mark.parametrize("name_bytes", [16, 1])
def test_exact_groups(spark, name_bytes):
    """One-byte names make different chunks share a name, so that identifiers must tell them apart."""
    frame = spark.createDataFrame(awkward(), SCHEMA).repartition(5)
    got = bag(exact_dedup.exact_groups(frame, mean=256, name_bytes=name_bytes))
    assert got == bag(spark.createDataFrame(plain_groups(awkward()), "a long, b long, c long, d boolean, e string"))


def test_empty_tables(spark):
    frame = spark.createDataFrame([], SCHEMA)
    assert rows(exact_dedup.exact_groups(frame)) == rows(simhash.simhash_groups(frame)) == []


def plain_print(text):
    words = [w for w in "".join(c.lower() if c.isascii() else c for c in text or "").replace("\x0b", " ").replace("\x0c", " ").replace("\t", " ").replace("\n", " ").replace("\r", " ").split(" ") if w]
    if not words:
        return 0
    size = min(3, len(words))
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + size]).encode(), 42) for i in range(len(words) - size + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints, radius):
    root = {p: p for p in prints}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in combinations(list(root), 2):
        if (a ^ b).bit_count() <= radius:
            root[max(top(a), top(b))] = min(top(a), top(b))
    return {p: top(p) for p in root}


def test_fingerprints_and_groups(spark):
    dice = random.Random(8)
    words = ["".join(dice.choices("abcdefgÉé", k=4)) for _ in range(60)]
    texts = [None, "", "\t\n", "One", "one TWO", "É é", "a\x1cb c d"]
    for _ in range(12):
        base = dice.choices(words, k=dice.randint(30, 300))
        for _ in range(4):
            copy = list(base)
            copy[dice.randrange(len(copy))] = dice.choice(words)
            texts.append(" ".join(copy))
    data = [(i, t, "x", True) for i, t in enumerate(texts)] + [(3, "One", "x", True), (None, "One", "x", True), (None, "no id at all", "x", True)]
    prints = {t: plain_print(t) for _, t, *_ in data}
    assert all(simhash.fingerprint(t, 3) % 2**64 == p for t, p in prints.items())
    top = plain_components(set(prints.values()), 2)
    least: dict[int, int | None] = {}
    for i, t, *_ in data:
        r = top[prints[t]]
        least[r] = min((x for x in (least.get(r), i) if x is not None), default=None)
    want = [(i, f"{prints[t]:016x}", least[top[prints[t]]]) for i, t, *_ in data]
    got = simhash.simhash_groups(spark.createDataFrame(data, SCHEMA).repartition(3))
    assert bag(got) == bag(spark.createDataFrame(want, "a long, b string, c long"))
    assert len(set(least.values())) < len(set(prints.values()))  # some did link


@pytest.mark.parametrize("radius", [1, 2, 3])
def test_links_of_any_radius(spark, radius):
    dice = random.Random(radius)
    prints = {0, -1, 2**63 - 1}
    for _ in range(6):
        base = dice.getrandbits(64)
        prints |= {((base ^ sum(1 << b for b in dice.sample(range(64), k))) + 2**63) % 2**64 - 2**63 for k in (0, 1, 2, 3, 4)}
    found = components(simhash.near_links(spark.createDataFrame([(p,) for p in prints], "print long"), radius))
    got = {r["node"]: r["component"] for r in found.collect()}
    assert {p: got.get(p, p) for p in prints} == {p: r for p, r in plain_components_signed(prints, radius).items()}


def plain_components_signed(prints, radius):
    root = {p: p for p in prints}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in combinations(sorted(root), 2):
        if ((a ^ b) % 2**64).bit_count() <= radius:
            root[max(top(a), top(b))] = min(top(a), top(b))
    return {p: top(p) for p in root}


def test_components_of_chains_stars_and_rings(spark):
    chain = [(i, i + 1) for i in range(40)]
    star = [(100, 100 + i) for i in range(1, 30)]
    ring = [(200 + i, 200 + (i + 1) % 9) for i in range(9)]
    odd = [(5, 5), (None, 3), (7, None), (101, 100), (300, 299)]
    got = by_key(components(spark.createDataFrame(chain + star + ring + odd, "a long, b long")), "node")
    want = {**{i: 0 for i in range(1, 41)}, **{100 + i: 100 for i in range(1, 30)}, **{200 + i: 200 for i in range(1, 9)}, 300: 299}
    assert {n: r["component"] for n, r in got.items()} == want
    assert rows(components(spark.createDataFrame([], "a long, b long"))) == []
