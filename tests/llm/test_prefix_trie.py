"""Prefix trie against a plain one, with long and repeated conversations, over few and many partitions."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from helpers import bag, rows
from pyspark.sql import functions as F

from recordkit.llm import prefix_trie as trie

EMPTY = hashlib.sha256().hexdigest()


def plain_trie(paths: dict[int, list[tuple[str, str]]]) -> list[tuple]:
    members, ends = defaultdict(list), defaultdict(list)
    for conv in sorted(paths):
        for depth in range(len(paths[conv]) + 1):
            members[tuple(paths[conv][:depth])].append(conv)
        ends[tuple(paths[conv])].append(conv)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    out, below = [], {}
    for node in sorted(members, key=len, reverse=True):
        own = (len(members[node]) - 1) * (len(node[-1][1]) if node else 0)
        kids = children[node]
        below[node] = (sum(below[k][0] for k in kids) if kids else 1, own + sum(below[k][1] for k in kids))
        digest = hashlib.sha256(",".join(map(str, ends[node])).encode()).hexdigest()
        parent = members[node[:-1]][0] if node else None
        out.append((members[node][0], len(node), parent, len(members[node]), len(kids), *below[node], digest))
    return out


def placed(data: list[tuple]) -> dict[int, list[tuple[str, str]]]:
    """Turns of each conversation in order; ties do not matter where they are equal."""
    paths = defaultdict(list)
    for conv, _, role, text in sorted((r for r in data if r[0] is not None), key=lambda r: (r[0], r[1] is not None, r[1] or 0)):
        paths[conv].append((role or "", text or ""))
    return dict(paths)


def frame_of(spark, data, n=5):
    rows_ = [(c, t, r, x, 1, 2) for c, t, r, x in data]
    random.Random(9).shuffle(rows_)
    return spark.createDataFrame(rows_, "conv_id long, turn long, role string, text string, depth int, k1 int").repartition(n)


def conversations(seed: int) -> list[tuple]:
    dice = random.Random(seed)
    says = [("user", "hi"), ("assistant", "hi"), ("user", "é🙂"), (None, None), ("user", "u" * 30), ("us", "erhi"), ("system", "")]
    data = []
    for conv in range(120):
        for turn in range(dice.randint(1, 12)):
            role, text = says[0] if turn == 0 and conv % 3 else dice.choice(says)
            data.append((conv, turn or None, role, text))
    long = [dice.choice(says) for _ in range(90)]
    for conv in (200, 201, 199):  # long ones that share 70 turns
        data += [(conv, t, *(long[t] if t < 70 else ("user", f"{conv} {t}"))) for t in range(85 if conv == 201 else 90)]
    for conv in range(300, 360):  # copies
        data += [(conv, t, *long[t]) for t in range(9)]
    data += [(-7, 0, "user", "hi"), (-7, 0, "user", "hi"), (None, 0, "user", "hi"), (None, None, None, None)]
    return data


@pytest.mark.parametrize("n", [1, 9])
def test_against_a_plain_trie(spark, partitions, monkeypatch, n):
    partitions(n)
    monkeypatch.setattr(trie, "BLOCKS", 3)
    monkeypatch.setattr(trie, "JOINED", 7)
    data = conversations(n)
    turns = trie.placed_turns(frame_of(spark, data))
    got = trie.prefix_trie(turns, turns.filter("place = 0").select("conv_id"))
    assert got.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert {t for _, t in got.dtypes[:7]} == {"bigint"}
    assert sorted(rows(got), key=str) == sorted(plain_trie(placed(data)), key=str)


def test_one_conversation_on_most_rows(spark, partitions):
    partitions(6)
    data = [(1, t, "user", f"{t % 3}") for t in range(4_000)] + [(c, 0, "user", "0") for c in range(2, 40)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        turns = trie.placed_turns(frame_of(spark, data))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert sorted(rows(turns.filter("conv_id = 1").select("place"))) == [(i,) for i in range(4_000)]
    sizes = [r["n"] for r in turns.groupBy(F.input_file_name().alias("f")).agg(F.count(F.lit(1)).alias("n")).collect()]
    assert max(sizes) < 2_500  # the conversation lies in several ranges
    got = {(r["conv_id"], r["depth"]): r for r in trie.prefix_trie(turns, turns.filter("place = 0").select("conv_id")).collect()}
    assert len(got) == 4_001 and got[1, 1]["n_convs"] == 39 and got[1, 4_000]["n_children"] == 0 and got[1, 0]["saved_tokens"] == 38
    assert got[1, 1]["ends_sha256"] == hashlib.sha256(",".join(map(str, range(2, 40))).encode()).hexdigest() and got[1, 7]["ends_sha256"] == EMPTY


def test_grafted_heads(spark):
    dice = random.Random(5)
    own = {c: [("r", f"{c}.{i}") for i in range(dice.randint(1, 8))] for c in [*range(0, 240), 305, 306, 450] if c not in (3, 100)}
    own[200] = own[200][:2]  # shorter than some heads that are taken from it
    data = [(c, i, *t) for c, turns in own.items() for i, t in enumerate(turns)]
    head = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 6
    turns = trie.placed_turns(frame_of(spark, data))
    rebuilt = trie.grafted(turns, F.col("conv_id") - F.col("conv_id") % 100, head, most=5)
    want = {}
    for c, turns_ in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        want[c] = own.get(c - c % 100, [])[:h] + turns_[h:]
    assert any(not w for w in want.values())  # some are left without turns
    got = trie.prefix_trie(rebuilt, turns.filter("place = 0").select("conv_id"))
    assert bag(got) == bag(spark.createDataFrame(plain_trie(want), got.schema))
    gapless = rebuilt.groupBy("conv_id").agg(F.max("place").alias("last"), F.count_distinct("place").alias("n"), F.count(F.lit(1)).alias("rows"))
    assert gapless.filter("last + 1 != n OR n != rows").count() == 0


def test_no_conversations(spark):
    turns = trie.placed_turns(frame_of(spark, [(None, 1, "user", "x")]))
    assert rows(trie.prefix_trie(turns, turns.select("conv_id"))) == []


def test_long_texts_and_ids_of_turns(spark):
    data = [("a", "b:c"), ("a:", "bc"), (None, "x"), ("", "x"), ("u", "é" * 300_000), ("u", None), ("u", "")]
    frame = spark.createDataFrame(data, "role string, text string").select(trie.turn_id(F.col("role"), F.col("text")).alias("t"))
    got = [(r["t"], r["n"]) for r in frame.select("t", trie.chars_of(F.col("t")).alias("n")).collect()]
    assert [n for _, n in got] == [3, 2, 1, 1, 300_000, 0, 0] and len({bytes(t) for t, _ in got}) == 5
