"""BPE encoding and decoding with content-defined chunk reuse.

Texts are cut by a rolling hash. Chunks that occur more than once in the corpus are encoded once, all others where they
stand. A cut may fall into a word, so each join is encoded again from the text, in a window that takes in words of both
chunks. The join agrees once the window's ids begin and end with the ids that these words have within their chunks;
until then the window is doubled.
"""

from __future__ import annotations

import hashlib
import os
import struct
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache, partial
from typing import Any

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F
from tokenizers import Tokenizer

from recordkit.llm.chunking import cuts
from recordkit.llm.common import map_rows, row_numbers, words_of
from recordkit.sources.tables import stage

MEAN = 1024
# ASCII white space; other white space stays inside what is called a word here, where the tokenizer finds it.
BLANK = b" \t\n\r\x0b\x0c"
# Words whose ids a Python process remembers, from one task to the next, and the bytes of such a word at most. When these are full, it goes on with those
# used since and forgets the rest the next time: two such tables, about 85 MB, at most, in each of
# an executor's Python processes.
WORDS, WORD_BYTES = 160_000, 64
# Bytes of text whose new words are encoded together, but for a longer text or chunk.
TOGETHER = 1 << 20
# A word that hardly any text holds; it stands between words that are encoded together.
MARK = b"\x01"
BETWEEN = b" " + MARK + b" "
# Chunk names that a task remembers as sent.
SENT = 100_000
# Bits of the filter that tells most chunks without a twin: so many for each shared chunk, within these bounds (2 KB and 64 MB). 0.5 GB of text had
# 55,000 shared chunks, so the upper bound is met at some 300 GB. Each chunk sets four bits: 1 in 400 without a twin is not told at 16 bits for each, 1
# in 6 at four. A chunk that is not told costs time, not rows.
BITS_PER_CHUNK, LEAST_BITS, MOST_BITS = 16, 1 << 14, 1 << 29
# Bits of the filter that travel as one row.
PART_BITS = 1 << 14


class Encoder:
    """Ids and decoded text of byte texts that begin and end at white space, word by word."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs one task per core
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        # The mark's id, if it is one token.
        alone = self.tokenizer.encode(MARK.decode(), add_special_tokens=False).ids
        self.mark = alone[0] if len(alone) == 1 else None
        self.known: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}

    def ids(self, text: bytes) -> bytes:
        """Ids as little-endian 32-bit numbers."""
        return b"".join(self.ids_of_words(text.split()))

    def ids_of_all(self, texts: list[bytes]) -> list[bytes]:
        """The same for each of several texts; of ``TOGETHER`` bytes of them each different word is looked up once, and the new ones are encoded in one call."""
        out: list[bytes] = []
        for part in gathered(texts, len):
            words, ends = words_of(part)
            coded = words.dictionary_encode()
            ids = pa.array(self.ids_of_words(coded.dictionary.to_pylist()), pa.large_binary()).take(coded.indices)
            held, at = contents(ids)
            bounds = at[ends].tolist()
            out += [held[first:last].to_pybytes() for first, last in zip(bounds, bounds[1:])]
        return out

    def ids_of_words(self, words: list[bytes]) -> list[bytes]:
        """Ids of each word, remembered or new; the new ones are encoded in one call."""
        if len(self.known) > WORDS:
            self.older, self.known = self.known, {}
        known, older = self.known, self.older
        found = list(map(known.get, words))
        new = [w for w, ids in zip(words, found) if ids is None]
        if new:
            fresh = {w: older[w] for w in new if w in older}
            fresh.update(self.apart([w for w in new if w and w not in fresh]))
            known.update((w, ids) for w, ids in fresh.items() if len(w) <= WORD_BYTES)
            fresh[b""] = b""
            found = [fresh[w] if ids is None else ids for w, ids in zip(words, found)]
        return found

    def apart(self, words: list[bytes]) -> Iterator[tuple[bytes, bytes]]:
        """Each word with its ids. Words are encoded as one text with marks between, which is cut at the mark's id; those that hold a mark are texts of their own."""
        marked = [w for w in words if self.mark is not None and MARK not in w]
        for start in range(0, len(marked), 1000):
            part = marked[start : start + 1000]
            ids = np.array(self.tokenizer.encode_batch_fast([BETWEEN.join(part).decode("utf-8", "surrogatepass")], add_special_tokens=False)[0].ids, dtype="<u4")
            ends = np.flatnonzero(ids == self.mark)
            if len(ends) != len(part) - 1:  # the mark's id stands for other text as well
                yield from zip(part, self.running(part))
                continue
            held, at = ids.tobytes(), (4 * ends).tolist()
            yield from zip(part, [held[first:last] for first, last in zip([0, *[e + 4 for e in at]], [*at, len(held)])])
        single = [w for w in words if self.mark is None or MARK in w]
        for start in range(0, len(single), 4096):
            yield from zip(single[start : start + 4096], self.running(single[start : start + 4096]))

    def running(self, texts: list[bytes]) -> list[bytes]:
        """Ids of texts that are encoded in one piece each."""
        encoded = self.tokenizer.encode_batch_fast([t.decode("utf-8", "surrogatepass") for t in texts], add_special_tokens=False)
        return [packed(one.ids) for one in encoded]

    def joined(self, joins: list[tuple[bytes, bytes, bytes]]) -> list[bytes]:
        """Ids of joins, given with the chunks on both sides: encoded with words of both until these agree with their ids in the chunks."""
        out, open_joins, words = [b""] * len(joins), range(len(joins)), 1
        while open_joins:
            sides = [(last_words(joins[k][0], words), first_words(joins[k][2], words)) for k in open_joins]
            windows = self.running([before + joins[k][1] + after for k, (before, after) in zip(open_joins, sides)])
            left = []
            for k, (before, after), ids in zip(open_joins, sides, windows):
                start, end = self.ids(before), self.ids(after)
                if len(ids) >= len(start) + len(end) and ids.startswith(start) and ids.endswith(end):
                    out[k] = ids[len(start) : len(ids) - len(end)]
                elif before == joins[k][0] and after == joins[k][2]:
                    raise ValueError("the tokenizer's tokens depend on text beyond white space, so chunks cannot be encoded apart")
                else:
                    left.append(k)
            open_joins, words = left, 2 * words
        return out


def contents(values: pa.Array) -> tuple[pa.Buffer, np.ndarray]:
    """The bytes of a large binary array that is no slice, and the offsets of its values."""
    _, offsets, held = values.buffers()
    return held or pa.py_buffer(b""), np.frombuffer(offsets, dtype=np.int64, count=len(values) + 1)


def gathered(items: Iterable, size: Callable[[Any], int]) -> Iterator[list]:
    """The items as lists that end with the item that brings them to ``TOGETHER`` bytes."""
    part, held = [], 0
    for item in items:
        part.append(item)
        held += size(item)
        if held >= TOGETHER:
            yield part
            part, held = [], 0
    if part:
        yield part


def packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


def first_words(text: bytes, n: int) -> bytes:
    """The text up to its n-th word and the white space after it."""
    parts = text.split(None, n)
    return text[: len(text) - len(parts[n])] if len(parts) > n else text


def last_words(text: bytes, n: int) -> bytes:
    """The text from the white space before the last n words on."""
    parts = text.rsplit(None, n)
    return text[len(parts[0]) :] if len(parts) > n else text


class Decoder:
    """What the tokenizer's decode gives for whole id lists: its decoder is none, so tokens stand with a blank between."""

    def __init__(self, tokenizer: Tokenizer):
        if tokenizer.decoder is not None:
            raise ValueError("only tokenizers without a decoder component can be decoded token by token")
        size = tokenizer.get_vocab_size(with_added_tokens=True)
        tokens = [tokenizer.id_to_token(i) for i in range(size)]
        self.tokens = pa.array([b"" if t is None else t.encode() + b" " for t in tokens], pa.large_binary())

    def text(self, ids: np.ndarray) -> bytes:
        held, at = contents(self.tokens.take(pa.array(ids)))
        return held[: max(int(at[-1]) - 1, 0)].to_pybytes()


@lru_cache(maxsize=1)
def encoder_of(path: str) -> Encoder:
    """The encoder of this Python process, which serves one task after the other."""
    return Encoder(path)


@lru_cache(maxsize=1)
def decoder_of(path: str) -> Decoder:
    return Decoder(encoder_of(path).tokenizer)


def interior(chunk: bytes) -> tuple[bytes, bytes, bytes] | None:
    """The chunk's start up to its first white space, the whole words between, and its end after the last white space;
    None without white space."""
    head = chunk.split(None, 1)[0] if chunk and chunk[0] not in BLANK else b""
    if len(head) == len(chunk):
        return None
    tail = chunk.rsplit(None, 1)[-1] if chunk[-1] not in BLANK else b""
    return head, chunk[len(head) : len(chunk) - len(tail)], tail


def pieces(data: bytes) -> list[tuple[bool, bytes, bytes]]:
    """The text as a list of (is a chunk, name, bytes): interiors of chunks, which may be shared, and joins, which are the
    text between two interiors. A chunk without white space is part of the join around it."""
    out: list[tuple[bool, bytes, bytes]] = []
    start, open_join = 0, []
    for end in cuts(data, MEAN, MEAN // 4, 8 * MEAN):
        chunk = data[start:end]
        start = end
        parts = interior(chunk)
        if parts is None:
            open_join.append(chunk)
            continue
        head, inside, tail = parts
        if open_join or head:
            out.append((False, b"", b"".join([*open_join, head])))
        if inside.strip():
            out.append((True, hashlib.blake2b(inside, digest_size=16).digest(), inside))
        open_join = [tail] if tail else []
    if open_join:
        out.append((False, b"", b"".join(open_join)))
    return out


def _names(rows: Iterator[tuple]) -> Iterator[tuple]:
    for (text,) in rows:
        for is_chunk, name, _ in pieces((text or "").encode("utf-8", "surrogatepass")):
            if is_chunk:
                yield (name,)


def _places(name: bytes, bits: int) -> list[int]:
    """The bits of a name: one for each four of its bytes."""
    return [place % bits for place in struct.unpack(">4I", name)]


def _packed_bits(rows: Iterator[tuple]) -> Iterator[tuple]:
    for part, places in rows:
        bits = np.zeros(PART_BITS, dtype=np.uint8)
        bits[places] = 1
        yield part, np.packbits(bits, bitorder="little").tobytes()


def filter_of(names: DataFrame) -> bytes:
    """Bits of the places of ``names``; as many bits as their number asks for."""
    wanted = BITS_PER_CHUNK * names.count()
    size = min(max(LEAST_BITS, 1 << max(wanted - 1, 0).bit_length()), MOST_BITS)
    quarters = [F.conv(F.hex(F.expr(f"substring(name, {first}, 4)")), 16, 10).cast("long") % size for first in (1, 5, 9, 13)]
    place = F.col("place")
    placed = names.select(F.explode(F.array(*quarters)).alias("place")).select(F.floor(place / PART_BITS).alias("part"), (place % PART_BITS).cast("int").alias("at"))
    # A set holds as many places as a part has bits at most.
    listed = placed.groupBy("part").agg(F.collect_set("at").alias("places"))
    bits = bytearray(size // 8)
    for part, value in map_rows(listed, ["part", "places"], _packed_bits, "part long, bits binary").toLocalIterator():
        bits[part * PART_BITS // 8 : (part + 1) * PART_BITS // 8] = value
    return bytes(bits)


def _encode(rows: Iterator[tuple], path: str, shared: Callable[[], bytes]) -> Iterator[tuple]:
    """A row per text: finished if no chunk of it can have a twin, else its own ids and the names to be filled in; and
    each chunk that may have a twin once per task."""
    encoder, decoder, numbers = encoder_of(path), decoder_of(path), row_numbers()
    bits, sent = shared(), set()
    size = 8 * len(bits)
    squeeze = zstandard.ZstdCompressor(level=3)
    encoded = ((doc_id, (text or "").encode("utf-8", "surrogatepass")) for doc_id, text in rows)
    for group in gathered(encoded, lambda row: len(row[1])):
        texts = [(doc_id, pieces(data)) for doc_id, data in group]
        twins = [[is_chunk and all(bits[at >> 3] >> (at & 7) & 1 for at in _places(name, size)) for is_chunk, name, _ in cut] for _, cut in texts]
        # Joins are where the text was cut: between two chunks, not at its ends.
        inner = [[not is_chunk and 0 < i < len(cut) - 1 for i, (is_chunk, _, _) in enumerate(cut)] for _, cut in texts]
        alone, joins = [], []
        for (_, cut), twin, between in zip(texts, twins, inner):
            alone += [cut[i][2] for i in range(len(cut)) if not twin[i] and not between[i]]
            joins += [(cut[i - 1][2] if cut[i - 1][0] else b"", cut[i][2], cut[i + 1][2] if cut[i + 1][0] else b"") for i in range(len(cut)) if between[i]]
        alone, joins = iter(encoder.ids_of_all(alone)), iter(encoder.joined(joins))
        for (doc_id, cut), twin, between in zip(texts, twins, inner):
            parts = [(cut[i][1], b"") if twin[i] else (b"", next(joins if between[i] else alone)) for i in range(len(cut))]
            if not any(twin):
                yield doc_id, next(numbers), None, None, *finished(b"".join(ids for _, ids in parts), decoder), None, None
                continue
            for i in range(len(cut)):
                _, name, data = cut[i]
                if twin[i] and name not in sent:
                    if len(sent) >= SENT:
                        sent.clear()
                    sent.add(name)
                    yield None, None, name, squeeze.compress(data), None, None, None, None, None
            own, names, tokens = [], [], 0
            for name, ids in parts:
                own.append(ids)
                tokens += len(ids) // 4
                if name:
                    names.append((tokens, name))
            yield doc_id, next(numbers), None, None, None, None, None, squeeze.compress(b"".join(own)), names


def finished(ids: bytes, decoder: Decoder) -> tuple[int, str, str]:
    return len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(decoder.text(np.frombuffer(ids, dtype="<u4"))).hexdigest()


def _encode_chunks(rows: Iterator[tuple], path: str) -> Iterator[tuple]:
    encoder, loosen, squeeze = encoder_of(path), zstandard.ZstdDecompressor(), zstandard.ZstdCompressor(level=3)
    for group in gathered(((name, loosen.decompress(chunk)) for name, chunk in rows), lambda row: len(row[1])):
        for (name, _), ids in zip(group, encoder.ids_of_all([chunk for _, chunk in group])):
            yield name, squeeze.compress(ids)


def _fill(rows: Iterator[tuple], path: str) -> Iterator[tuple]:
    decoder, loosen = decoder_of(path), zstandard.ZstdDecompressor()
    for doc_id, own, found in rows:
        own, out, last = loosen.decompress(own), [], 0
        for one in found:
            out += [own[4 * last : 4 * one["size"]], loosen.decompress(one["ids"])]
            last = one["size"]
        yield doc_id, *finished(b"".join([*out, own[4 * last :]]), decoder)


def encode(docs: DataFrame, tokenizer_path: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id``, ``n_tokens``, ``ids_sha256`` and ``decoded_sha256`` for every row, as one call on the whole text gives.

    The names of all chunks are counted; those that occur twice or more set bits in a filter sized by their number, which
    goes to every task. Texts without such a chunk are encoded where they are read. Of the others, only the shared chunks
    (once per task, then once in all) and the ids around them move. Fits tokenizers whose tokens never cross
    ASCII white space and that have no decoder component (a join that never agrees ends the run); ``tokenizer_path`` must be readable
    on every executor. Texts of any length are cut in one pass; what has no white space for long is one join.

    A null text counts as empty: no tokens, digests of no bytes. Repeated rows give repeated results, null ids stay
    null. Other columns are not read. No rows give no rows.
    """
    spark = docs.sparkSession
    kind = docs.schema[id_column].dataType.simpleString()
    named = map_rows(docs, [text_column], _names, "name binary")
    shared = stage(named.groupBy("name").agg(F.count(F.lit(1)).alias("uses")).filter("uses > 1").select("name"), "shared-chunks")
    bits = spark.sparkContext.broadcast(filter_of(shared))
    schema = f"doc_id {kind}, row long, name binary, chunk binary, n_tokens long, ids_sha256 string, decoded_sha256 string, own binary, names array<struct<size: int, name: binary>>"
    work = partial(_encode, path=tokenizer_path, shared=partial(_value, bits))
    written = stage(map_rows(docs, [id_column, text_column], work, schema), "encoded")
    result = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    chunks = written.filter("chunk is not null").select("name", "chunk").dropDuplicates(["name"])
    encoded = map_rows(chunks, ["name", "chunk"], partial(_encode_chunks, path=tokenizer_path), "name binary, ids binary")
    waiting = written.filter("own is not null")
    wanted = waiting.select("row", F.posexplode("names").alias("place", "at")).select("row", "place", "at.size", "at.name")
    found = wanted.join(encoded, "name").groupBy("row").agg(F.array_sort(F.collect_list(F.struct("place", "size", "ids"))).alias("found"))
    whole = waiting.select("row", "doc_id", "own").join(found, "row")
    filled = map_rows(whole, ["doc_id", "own", "found"], partial(_fill, path=tokenizer_path), f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
    return written.filter("ids_sha256 is not null").select(*result).unionByName(filled)


def _value(broadcast) -> bytes:
    return broadcast.value
