"""Token ids and decoded texts against one call of the tokenizer on each whole text."""

from __future__ import annotations

import hashlib
import random
import struct
import sys

import public_tokenizers
import pytest
from helpers import rows
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from recordkit.llm import bpe
from recordkit.llm.chunking import cuts

PATH = public_tokenizers.path("word_bpe_49k.json")
WHOLE = Tokenizer.from_file(PATH)
WHOLE.no_padding()
WHOLE.no_truncation()


def expected(text: str | None) -> tuple[int, str, str]:
    ids = WHOLE.encode(text or "", add_special_tokens=False).ids
    return len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(), hashlib.sha256(WHOLE.decode(ids, skip_special_tokens=False).encode()).hexdigest()


SAMPLES = [
    None, "", " ", "\n\t", "That it.", "It's we'LL   don't", "É é ́a a ́", "x y z\u0085w\x1cq\x0bv\x0cu",
    "<|startoftext|>a <|endoftext|>b<|endoftext|> <|STARTOFTEXT|>", "日本語のテキスト 한국어", "ΣΑΣ İ ẞ ﬁ K", "🙂🙂 a‍b", "1234 5 6a7",
    "q" * 30_000, "ab " * 20_000, "á" * 5_000,
]


def test_matches_whole_texts(spark):
    random.seed(1)
    words = ["".join(random.choice("aeioubcdé'.,!1") for _ in range(random.randint(1, 9))) for _ in range(400)]
    long = [" ".join(random.choices(words, k=4_000)) for _ in range(3)]
    texts = SAMPLES + long + long[:2] + [long[0] + long[1], "x" + long[0], long[1][7_000:] + "end"] + ["That it."] * 3
    frame = spark.createDataFrame([(i if i != 3 else None, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, n_tokens string").repartition(3)
    got = {r[0]: r[1:] for r in rows(bpe.encode(frame, PATH))}
    assert got == {(i if i != 3 else None): expected(t) for i, t in enumerate(texts)}


def test_empty_table_and_repeated_rows(spark):
    frame = spark.createDataFrame([], "doc_id long, text string")
    assert rows(bpe.encode(frame, PATH)) == []
    text = "some words " * 500
    twice = spark.createDataFrame([(1, text), (1, text)], "doc_id long, text string")
    assert rows(bpe.encode(twice, PATH)) == [(1, *expected(text))] * 2


ENCODER = bpe.Encoder(PATH)


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(" \n\t\x0b\x0c\r\x1c\x85 'sté́aB1<|>"), st.characters(codec="utf-8")), max_size=80))
def test_words_encode_alone(text):
    assert ENCODER.ids(text.encode()) == struct.pack("<%dI" % len(i := WHOLE.encode(text, add_special_tokens=False).ids), *i)


def test_text_without_white_space(spark):
    """One join of 5 MB: cut in one pass, encoded once."""
    random.seed(2)
    long = "".join(random.choices("abcd1.", k=5_000_000))
    frame = spark.createDataFrame([(1, long), (2, "some words " + long[:30_000] + " and others")], "doc_id long, text string")
    assert sorted(rows(bpe.encode(frame, PATH))) == [(1, *expected(long)), (2, *expected("some words " + long[:30_000] + " and others"))]


def test_full_filter_costs_no_rows(spark, monkeypatch):
    """Where every chunk passes for shared, each is filled in from its one encoding."""
    monkeypatch.setattr(bpe, "filter_of", lambda names: b"\xff" * 64)
    random.seed(3)
    texts = [" ".join(random.choices(["alpha", "beta's", "Gamma", "delta-9", "\u00e9t\u00e9"], k=3_000)) for _ in range(5)]
    frame = spark.createDataFrame(list(enumerate([*texts, texts[0]])), "doc_id long, text string")
    assert sorted(rows(bpe.encode(frame, PATH))) == [(i, *expected(t)) for i, t in enumerate([*texts, texts[0]])]


def test_filter_holds_every_name_and_grows_with_them(spark):
    names = [hashlib.blake2b(str(i).encode(), digest_size=16).digest() for i in range(3_000)]
    bits = bpe.filter_of(spark.createDataFrame([(n,) for n in names], "name binary"))
    size = 8 * len(bits)
    places = {p for n in names for p in bpe._places(n, size)}
    assert size == 1 << 16 and {p for p in range(size) if bits[p >> 3] >> (p & 7) & 1} == places
    assert bpe.filter_of(spark.createDataFrame([], "name binary")) == bytes(bpe.LEAST_BITS // 8)


def test_joins_are_encoded_until_they_agree():
    """A tokenizer whose first id changes in short texts: the window grows to them."""

    class Counting(bpe.Encoder):
        def __init__(self, reach):
            self.reach, self.windows = reach, []

        def ids(self, text):
            return bpe.packed([len(w) for w in text.split()])

        def running(self, texts):
            self.windows.append(max(len(t.split()) for t in texts))
            return [bpe.packed([len(w) + (1000 if i == 0 and len(t.split()) < self.reach else 0) for i, w in enumerate(t.split())]) for t in texts]

    left, right = b" a bb ccc dddd eeeee ", b" f gg hhh iiii jjjjj "
    near, far, never = Counting(0), Counting(8), Counting(100)
    assert near.joined([(left, b"xyz", right)] * 2) == [bpe.packed([3])] * 2 and near.windows == [3]
    assert far.joined([(left, b"xyz", right)]) == [bpe.packed([3])] and far.windows == [3, 5, 9]
    with pytest.raises(ValueError):
        never.joined([(left, b"xyz", right)])


@pytest.mark.parametrize("text, n, first, last", [(b" a b  c ", 1, b" a ", b"  c "), (b" a b  c ", 3, b" a b  c ", b" a b  c "), (b"  ", 2, b"  ", b"  "), (b"", 1, b"", b"")])
def test_words_at_the_ends(text, n, first, last):
    assert (bpe.first_words(text, n), bpe.last_words(text, n)) == (first, last)


def test_forgotten_words_are_encoded_again(monkeypatch):
    monkeypatch.setattr(bpe, "WORDS", 20)
    encoder, text = bpe.Encoder(PATH), " ".join(f"word{i % 70} {'x' * (i % 90)}" for i in range(900))
    for part in (text[i : i + 400] for i in range(0, len(text), 400)):
        assert encoder.ids(part.encode()) == bpe.packed(WHOLE.encode(part, add_special_tokens=False).ids)
    assert all(len(w) <= bpe.WORD_BYTES for w in encoder.known)


@pytest.mark.parametrize("size", [0, 1, 255, 5_000, 100_000])
def test_pieces_and_cuts_cover_the_text(size):
    random.seed(size)
    data = bytes(random.choice(b"abcdefgh  \n") for _ in range(size))
    assert b"".join(p[2] for p in bpe.pieces(data)).split() == data.split()
    ends = cuts(data, 1024, 256, 4096)
    assert ends == sorted(set(ends)) and (ends[-1] if ends else 0) == size
    assert all(b - a <= 4096 for a, b in zip([0, *ends], ends))


def test_new_words_are_encoded_as_one_text():
    """One text with marks between for all words but those that hold a mark; the ids are those of each word alone."""

    class Counted:
        def __init__(self, tokenizer):
            self.tokenizer, self.texts = tokenizer, []

        def encode_batch_fast(self, texts, **options):
            self.texts += texts
            return self.tokenizer.encode_batch_fast(texts, **options)

    encoder = bpe.Encoder(PATH)
    encoder.tokenizer = counted = Counted(encoder.tokenizer)
    words = [*(f"Wörd{i}'s," for i in range(500)), "\x01", "a\x01b", "\x01\x01", "<|endoftext|>x", "́a", "ā", "\x02"]
    text = " ".join(words)
    assert encoder.ids(text.encode()) == bpe.packed(WHOLE.encode(text, add_special_tokens=False).ids)
    assert len(counted.texts) == 4
    assert all(encoder.known[w.encode()] == bpe.packed(WHOLE.encode(w, add_special_tokens=False).ids) for w in words)
    encoder.mark, encoder.known = WHOLE.encode(",", add_special_tokens=False).ids[0], {}  # a mark whose id other text has: each word alone
    assert encoder.ids(text.encode()) == bpe.packed(WHOLE.encode(text, add_special_tokens=False).ids)


def test_new_words_of_many_short_texts_are_encoded_in_one_call(monkeypatch):
    """Short texts wait for each other, long ones are taken in parts; the rows are those of each text alone."""
    calls = []

    class Counted(bpe.Encoder):
        def apart(self, words):
            calls.append(len(words))
            return super().apart(words)

    monkeypatch.setattr(bpe, "Encoder", Counted)
    random.seed(4)
    texts = [" ".join("".join(random.choices("abcdé,", k=6)) for _ in range(20)) for _ in range(300)] + SAMPLES
    got = list(bpe._encode(iter(enumerate(texts)), PATH, lambda: bytes(2048)))
    assert [(r[0], *r[4:7]) for r in got] == [(i, *expected(t)) for i, t in enumerate(texts)]
    assert 0 < sum(n > 0 for n in calls) <= 12
    calls.clear()
    monkeypatch.setattr(bpe, "TOGETHER", 5_000)
    encoder = Counted(PATH)
    assert encoder.ids_of_all([t.encode() for t in texts[:300]]) == [bpe.packed(WHOLE.encode(t, add_special_tokens=False).ids) for t in texts[:300]]
    assert max(calls) < 1_000


def test_a_process_encodes_a_word_once(monkeypatch):
    """Tasks of one process share what it remembers: each of their words is encoded by the first that meets it, and looked up once for a group of texts, but for those at joins."""
    encoded, asked = [], []

    class Counted(bpe.Encoder):
        def apart(self, words):
            encoded.extend(words)
            return super().apart(words)

        def ids_of_words(self, words):
            asked.extend(words)
            return super().ids_of_words(words)

    monkeypatch.setattr(bpe, "Encoder", Counted)
    bpe.encoder_of.cache_clear()
    try:
        words = [f"wörd{i}'s" for i in range(200)]
        texts = [" " + " \t".join(words) + "\n", " ".join(words[::-1]), "", " ", *words[:50]]
        for _ in range(3):  # as three tasks do
            got = list(bpe._encode(iter(enumerate(texts)), PATH, lambda: bytes(2048)))
            assert [(r[0], *r[4:7]) for r in got] == [(i, *expected(t)) for i, t in enumerate(texts)]
        assert sorted(encoded) == sorted(w.encode() for w in words)
        assert len(asked) < 3 * (len(words) + 10)
    finally:
        bpe.encoder_of.cache_clear()


def test_remembered_words_stay_within_85_megabytes():
    encoder = bpe.Encoder(PATH)
    for start in range(0, 820_000, 20_000):
        encoder.ids_of_words([b"w%xq" % n for n in range(start, start + 20_000)])
    tables = [encoder.known, encoder.older]
    assert sum(sys.getsizeof(t) + sum(sys.getsizeof(w) + sys.getsizeof(ids) for w, ids in t.items()) for t in tables) < 85e6
