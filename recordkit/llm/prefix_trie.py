"""Prefix trie of conversations: every sequence of first turns is a node, found by ROLLUP over positional columns of turn ids.

A block holds the ids of ``WIDTH`` successive turns in columns, so one GROUP BY with ROLLUP gives all prefixes of all blocks at once, and
grouping_id tells how many turns each has. A long conversation goes on in further blocks, keyed by the node at which the
last one ended. A node's name is the exclusive or of hashes of its turns with their depths, so it is known without walking the trie.

Sums over subtrees need no walk either: each node belongs to its smallest conversation, which owns one stretch of its path down to its end. What
a conversation owns is summed over the members of a node by a second ROLLUP.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator
from functools import reduce

from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from recordkit.llm.common import map_rows
from recordkit.sources.tables import stage

WIDTH = 8
# Blocks of a conversation that one window sums up.
BLOCKS = 1_024
# Ids that are joined to one text before texts of a node meet.
JOINED = 4_096
DIGEST = 16
TURNS = [f"t{i}" for i in range(1, WIDTH + 1)]
NODE = ["depth", "k1", "k2"]


def turn_id(role: Column, text: Column) -> Column:
    """16 bytes of a digest of both, and the code points of the text; null counts as empty."""
    role, text = F.coalesce(role, F.lit("")), F.coalesce(text, F.lit(""))
    digest = F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)
    return F.unhex(F.concat(F.substring(digest, 1, 2 * DIGEST), F.lpad(F.hex(F.length(text)), 8, "0")))


def chars_of(turn: Column) -> Column:
    return F.conv(F.hex(F.substring(turn, DIGEST + 1, 4)), 16, 10).cast("long")


def _counted(rows: Iterator[tuple]) -> Iterator[tuple]:
    context = TaskContext.get()
    part, last, count = context.partitionId() if context else 0, None, 0
    for conv_id, turn in rows:
        count = count + 1 if conv_id == last else 0
        last = conv_id
        yield conv_id, part, count, turn


def placed_turns(rows: DataFrame, id_column: str = "conv_id", turn_column: str = "turn", role_column: str = "role", text_column: str = "text") -> DataFrame:
    """``conv_id``, ``place`` (from 0) and ``turn`` (its id) for each row with a conversation id, written.

    Turns are in the order of the turn column (null first), equal ones in that of their ids. Rows are dealt by ranges of this order and counted
    within each range; a conversation that goes on from an earlier range adds the rows that it has there, so no
    task holds a whole long conversation.
    """
    turn = turn_id(F.col(role_column), F.col(text_column))
    given = rows.select(F.col(id_column).cast("long").alias("conv_id"), F.col(turn_column).alias("at"), turn.alias("turn"), F.monotonically_increasing_id().alias("row"))
    order = ["conv_id", F.asc_nulls_first("at"), "turn", "row"]
    ranged = given.filter("conv_id IS NOT NULL").repartitionByRange(*order).sortWithinPartitions(*order)
    counted = stage(map_rows(ranged, ["conv_id", "turn"], _counted, "conv_id long, part int, count long, turn binary"), "counted-turns")
    edges = counted.groupBy("part").agg(F.min("conv_id").alias("first"), F.max(F.struct("conv_id", "count")).alias("last")).collect()  # a row per partition
    earlier, conv, held = [], None, 0
    for r in sorted(edges, key=lambda r: r["part"]):
        before = held if r["first"] == conv else 0
        if before:
            earlier.append((r["part"], r["first"], before))
        conv = r["last"]["conv_id"]
        held = r["last"]["count"] + 1 + (before if r["first"] == conv else 0)
    if earlier:
        table = F.broadcast(rows.sparkSession.createDataFrame(earlier, "part int, conv_id long, before long"))
        counted = counted.join(table, ["part", "conv_id"], "left").withColumn("count", F.col("count") + F.coalesce("before", F.lit(0)))
    return stage(counted.select("conv_id", F.col("count").alias("place"), "turn"), "placed-turns")


def grafted(placed: DataFrame, base: Column, head: Column, most: int) -> DataFrame:
    """Turns of conversations that begin with the first ``head`` turns (``most`` at most) of conversation ``base`` (both expressions on
    ``conv_id``), all if it has fewer, none if it has none; then come their own turns after their first ``head``."""
    wanted = placed.filter("place = 0").select("conv_id", base.alias("base"), head.alias("head"))
    heads = placed.filter((F.col("place") < most) & (F.col("conv_id") == base)).select(F.col("conv_id").alias("base"), "place", "turn")
    taken = wanted.join(heads, "base").filter(F.col("place") < F.col("head")).select("conv_id", "place", "turn")
    held = heads.groupBy("base").agg(F.count(F.lit(1)).alias("held"))
    less = F.col("head") - F.coalesce("held", F.lit(0))
    short = wanted.join(held, "base", "left").select("conv_id", less.alias("less")).filter("less > 0")
    own = placed.filter(F.col("place") >= head).join(short, "conv_id", "left")
    return taken.unionByName(own.select("conv_id", (F.col("place") - F.coalesce("less", F.lit(0))).alias("place"), "turn"))


def turn_hash(k: int, depth: Column, turn: Column) -> Column:
    """The ``k``-th hash of a turn at its depth."""
    return F.xxhash64(F.lit(k), depth.cast("long"), turn)


def xor(columns: list[Column]) -> Column:
    return reduce(lambda a, b: a.bitwiseXOR(b), columns)


def trie_blocks(placed: DataFrame, ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Blocks (``conv_id``, ``block``, the turns, the name ``k1``, ``k2`` of the node before and the code points up to there, the
    conversation's ``total``), and conversations (``conv_id``, ``depth``, name of the last node, ``total``), both written."""
    depth = F.col("place") + 1
    rows = placed.select("conv_id", depth.alias("depth"), "turn").unionByName(ids.select("conv_id", F.lit(0).cast("long").alias("depth"), F.lit(None).cast("binary").alias("turn")))
    slot = F.pmod(F.col("depth") - 1, F.lit(WIDTH))
    real = F.col("depth") > 0
    sums = [
        *[F.coalesce(F.bit_xor(F.when(real, turn_hash(k, F.col("depth"), F.col("turn")))), F.lit(0)).alias(f"x{k}") for k in (1, 2)],
        F.coalesce(F.sum(F.when(real, chars_of(F.col("turn")))), F.lit(0)).alias("chars"),
        F.max("depth").alias("depth"),
    ]
    turns = [F.max(F.when(real & (slot == i), F.col("turn"))).alias(name) for i, name in enumerate(TURNS)]
    block = F.expr(f"(greatest(depth, 1) - 1) div {WIDTH}")
    blocks = stage(rows.groupBy("conv_id", block.alias("block")).agg(*sums, *turns), "trie-turns")
    totals = blocks.groupBy("conv_id").agg(F.bit_xor("x1").alias("k1"), F.bit_xor("x2").alias("k2"), F.sum("chars").alias("total"), F.max("depth").alias("depth"))
    totals = stage(totals, "trie-conversations")
    # Sums of what comes before, first within groups of blocks, then of groups: no window holds a whole long conversation.
    group = F.expr(f"block div {BLOCKS}")
    within = Window.partitionBy("conv_id", "group").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    groups = Window.partitionBy("conv_id").orderBy("group").rowsBetween(Window.unboundedPreceding, -1)

    def before(over) -> dict[str, Column]:
        found = {"k1": F.bit_xor("x1").over(over), "k2": F.bit_xor("x2").over(over), "before": F.sum("chars").over(over)}
        return {name: F.coalesce(c, F.lit(0)) for name, c in found.items()}

    grouped = blocks.groupBy("conv_id", group.alias("group")).agg(F.bit_xor("x1").alias("x1"), F.bit_xor("x2").alias("x2"), F.sum("chars").alias("chars"))
    earlier = grouped.withColumns(before(groups)).filter("group > 0").select("conv_id", "group", *[F.col(n).alias(f"{n}_group") for n in ("k1", "k2", "before")])
    inner = blocks.withColumn("group", group).withColumns(before(within)).join(earlier, ["conv_id", "group"], "left")

    def with_group(name: str) -> Column:
        return F.coalesce(f"{name}_group", F.lit(0))

    keyed = inner.select(
        "conv_id",
        "block",
        F.col("k1").bitwiseXOR(with_group("k1")).alias("k1"),
        F.col("k2").bitwiseXOR(with_group("k2")).alias("k2"),
        (F.col("before") + with_group("before")).alias("before"),
        *TURNS,
    )
    return stage(keyed.join(totals.select("conv_id", "total"), "conv_id"), "trie-blocks"), totals


def rolled_up(blocks: DataFrame, sums: str) -> DataFrame:
    """Nodes (``depth``, ``k1``, ``k2``, their parent's ``q1``, ``q2``, ``chars`` of the last turn, code points ``before`` it) with ``sums`` over their members."""
    rolled = blocks.sparkSession.sql(
        f"""SELECT block, k1, k2, max(before) AS before, {", ".join(TURNS)}, {WIDTH} - bit_count(grouping_id()) AS level, {sums}
        FROM {{blocks}} GROUP BY block, k1, k2, ROLLUP ({", ".join(TURNS)})""",
        blocks=blocks,
    )
    last = F.get(F.array(*TURNS), F.col("level") - 1)
    # The first level of a later block is the last one of the block before; a missing turn is the end of other conversations.
    real = rolled.filter(((F.col("level") == 0) & (F.col("block") == 0)) | ((F.col("level") > 0) & last.isNotNull()))
    first = F.col("block") * WIDTH
    names = {}
    for k in (1, 2):
        hashes = [F.when(F.col(t).isNotNull(), turn_hash(k, first + i, F.col(t))).otherwise(F.lit(0)) for i, t in enumerate(TURNS, 1)]
        names[k] = xor([F.col(f"k{k}"), *hashes])
    own = F.when(last.isNotNull(), chars_of(last)).otherwise(F.lit(0))
    along = sum((F.when(F.col(t).isNotNull(), chars_of(F.col(t))).otherwise(F.lit(0)) for t in TURNS), F.lit(0))
    depth = first + F.col("level")
    up = {f"q{k}": F.when(last.isNotNull(), names[k].bitwiseXOR(turn_hash(k, depth, last))) for k in (1, 2)}
    kept = [c for c in rolled.columns if c not in {"block", "k1", "k2", "before", "level", *TURNS}]
    return real.select(
        depth.cast("long").alias("depth"), names[1].alias("k1"), names[2].alias("k2"), *[c.alias(n) for n, c in up.items()],
        own.alias("chars"), (F.col("before") + along - own).alias("before"), *kept,
    )


def _joined(rows: Iterator[tuple]) -> Iterator[tuple]:
    for key, own in itertools.groupby(rows, key=lambda r: r[:3]):
        while some := list(itertools.islice(own, JOINED)):
            yield *key, some[0][3], ",".join(str(r[3]) for r in some)


def _digested(rows: Iterator[tuple]) -> Iterator[tuple]:
    for key, own in itertools.groupby(rows, key=lambda r: r[:3]):
        digest, between = hashlib.sha256(), b""
        for *_, text in own:
            digest.update(between + text.encode())
            between = b","
        yield *key, digest.hexdigest()


def end_digests(conversations: DataFrame) -> DataFrame:
    """``ends_sha256`` of the ids, in order, of the conversations that end at each node. Ids are dealt by ranges and joined there, so that a node at
    which very many end sends few texts to the task that digests them."""
    order = [*NODE, "conv_id"]
    ranged = conversations.select(*order).repartitionByRange(*order).sortWithinPartitions(*order)
    texts = map_rows(ranged, order, _joined, "depth long, k1 long, k2 long, least long, ids string")
    sorted_texts = texts.repartition(*NODE).sortWithinPartitions(*NODE, "least")
    return map_rows(sorted_texts, [*NODE, "ids"], _digested, "depth long, k1 long, k2 long, ends_sha256 string")


def prefix_trie(placed: DataFrame, ids: DataFrame) -> DataFrame:
    """``conv_id`` (smallest member), ``depth``, ``parent_conv_id`` (null for the root), ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens`` and
    ``ends_sha256`` for each node: the root without turns, and every different sequence of first turns.

    ``placed`` holds ``conv_id`` (long), ``place`` (from 0, without gaps) and ``turn`` (see ``turn_id``), ``ids`` each ``conv_id`` once, those without turns included. Members of a
    node are the conversations that begin with it. ``n_leaves`` counts the nodes without children in its subtree, itself included; ``saved_tokens`` sums,
    over the subtree, all members but one times the code points of the last text; ``ends_sha256`` is the SHA-256 of the decimal ids of the conversations
    that are just this sequence, ascending and joined by commas (of no bytes where none is).

    Turns are equal if 128 bits of a digest of role and text are, and nodes if two 64-bit names are. Conversations of any length go through the same steps:
    their number does not grow with the length. No conversations give no rows, not even a root.
    """
    blocks, conversations = trie_blocks(placed, ids)
    nodes = stage(rolled_up(blocks, "min(conv_id) AS conv_id, count(*) AS n_convs, sum(total) AS total, min_by(total, conv_id) AS first_total"), "trie-nodes")
    children = nodes.filter("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("q1").alias("k1"), F.col("q2").alias("k2")).agg(F.count(F.lit(1)).alias("n_children"))
    counted = nodes.join(children, NODE, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    counted = stage(counted, "trie-counted")
    # What each conversation owns: the code points of its nodes, and whether its end is a leaf.
    owned = counted.groupBy("conv_id").agg(F.sum("chars").alias("own"), F.count(F.when(F.col("n_children") == 0, 1)).alias("leaves"))
    owners = stage(blocks.select("conv_id", "block", "k1", "k2", "before", *TURNS).join(owned, "conv_id"), "trie-owners")
    below = rolled_up(owners, "sum(own) AS own, sum(leaves) AS n_leaves, min_by(own, conv_id) AS first_own").select(*NODE, "own", "n_leaves", "first_own")
    merged = stage(counted.join(below, NODE).join(end_digests(conversations), NODE, "left"), "trie-sums")
    # Members' code points from here on, less those of the different nodes: all of the smallest member's, and what the others own.
    distinct = F.col("own") - F.col("first_own") + F.col("first_total") - F.col("before")
    saved = F.col("total") - F.col("n_convs") * F.col("before") - distinct
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("k1").alias("q1"), F.col("k2").alias("q2"), F.col("conv_id").alias("parent_conv_id"))
    return merged.join(parents, ["depth", "q1", "q2"], "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", saved.alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"),
    )
