"""Language by compression: the language whose words help zstandard most to shorten a text."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import partial

import zstandard
from pyspark.sql import DataFrame, Window, functions as F

from recordkit.llm.common import held_out, map_rows
from recordkit.sources.tables import stage

UNKNOWN = "und"
# Bytes of words in a language's dictionary.
DICTIONARY = 112 << 10
# Texts per language from which a dictionary is taken at most; about four times as many are looked at.
SAMPLES = 256
LEVEL = 6
# A margin is narrow below so many bytes, or below this share of the smallest size.
NARROW_BYTES, NARROW_SHARE = 2, 0.01
LETTERS = re.compile(r"[^\W\d_]+")


def letters(text: str | None) -> bytes:
    """The words of a text (runs of letters, in lower case), each once, in order of its first place."""
    words = dict.fromkeys(LETTERS.findall((text or "").lower()))
    if not any(map(str.isalpha, words)) and not any(c.isalpha() for w in words for c in w):
        return b""  # number signs alone
    return f" {' '.join(words)} ".encode("utf-8", "surrogatepass") if words else b""


def _samples(rows: Iterator[tuple], most: int) -> Iterator[tuple]:
    for language, at, text in rows:
        data = letters(text)
        if data:
            # A longer text is cut between two words, or within a word that is as long itself.
            cut = data if len(data) <= most else data[: data.rfind(b" ", 1, most) + 1] or data[:most]
            yield language, at, cut, len(cut), len(data) > most


def dictionaries(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", lang_column: str = "lang", size: int = DICTIONARY) -> list[tuple[str, bytes]]:
    """A language and its raw-content dictionary each, the most frequent language first.

    Learned from texts whose language is not null and whose row is not held out. Texts are taken in the order of a hash
    of the text, copies once, up to ``SAMPLES`` texts and ``size`` bytes of words per language; texts with more words than a
    dictionary come last and are cut to what is left. Shares drawn follow from the different texts with a letter, and are
    raised for languages of which too few came out. The driver gets up to twice ``size`` bytes per language.
    """
    given = docs.filter(F.col(lang_column).isNotNull() & ~held_out(F.col(id_column)))
    given = given.select(F.col(lang_column).alias("lang"), F.col(text_column).alias("text"), F.xxhash64(F.col(text_column)).alias("at"))
    usable = F.col("text").isNotNull() & F.col("text").rlike(r"\p{L}")
    different = F.approx_count_distinct(F.when(usable, F.col("at")), 0.05)
    rows = given.groupBy("lang").agg(F.count(F.lit(1)).alias("rows"), different.alias("texts")).collect()
    order = [r["lang"] for r in sorted(rows, key=lambda r: (-r["rows"], r["lang"])) if r["texts"]]
    # Shares of the hash's range that hold about four times the texts wanted.
    shares = {r["lang"]: min(1.0, 4 * SAMPLES / r["texts"]) for r in rows if r["texts"]}
    chosen: dict[str, list[tuple]] = {}
    while shares:
        edges = F.broadcast(docs.sparkSession.createDataFrame(list(shares.items()), "lang string, edge double"))
        place = F.col("at").cast("double") / 2.0**64 + 0.5
        once = given.filter(usable).join(edges, "lang").filter(place <= F.col("edge")).dropDuplicates(["lang", "at"])
        words = map_rows(once, ["lang", "at", "text"], partial(_samples, most=size), "lang string, at long, data binary, size long, cut boolean")
        by_hash = Window.partitionBy("lang").orderBy("cut", "at")  # of a bounded sample
        placed = words.select("*", F.sum("size").over(by_hash).alias("total"), F.row_number().over(by_hash).alias("n"), F.count(F.lit(1)).over(Window.partitionBy("lang")).alias("drawn"))
        fits = (F.col("total") <= size) | (F.col("cut") & (F.col("total") - F.col("size") < size))
        kept = stage(placed.filter(fits & (F.col("n") <= SAMPLES)).select("lang", "cut", "at", "data", "drawn"), "language-samples")
        chosen.update({language: [] for language in shares})
        drawn = dict.fromkeys(shares, 0)
        for row in kept.collect():
            chosen[row["lang"]].append((row["cut"], row["at"], bytes(row["data"])))
            drawn[row["lang"]] = row["drawn"]
        shares = {language: min(1.0, 8 * edge) for language, edge in shares.items() if edge < 1 and drawn[language] < SAMPLES}
    return [(language, b"".join(d for *_, d in sorted(chosen[language]))[:size]) for language in order if chosen[language]]


def compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    settings = zstandard.ZstdCompressionParameters.from_level(LEVEL, write_content_size=False, write_checksum=False)
    content = zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    return zstandard.ZstdCompressor(compression_params=settings, dict_data=content)


def judge(sizes: list[int]) -> tuple[int, float, bool]:
    """Place of the smallest size (the first of equals), its weight when a byte more halves a weight, and whether the
    lead over the next is narrow."""
    best = min(sizes)
    at = sizes.index(best)
    score = 1 / sum(2.0 ** -min(size - best, 1000) for size in sizes)
    lead = min((size for i, size in enumerate(sizes) if i != at), default=2 * best) - best
    return at, score, lead < max(NARROW_BYTES, NARROW_SHARE * best)


def _predict(rows: Iterator[tuple], known: list[tuple[str, bytes]]) -> Iterator[tuple]:
    press = [compressor(data) for _, data in known]
    for doc_id, out, text in rows:
        data = letters(text)
        if not data or not press:
            yield doc_id, out, UNKNOWN, 0.0, True
            continue
        at, score, narrow = judge([len(one.compress(data)) for one in press])
        yield doc_id, out, known[at][0], score, narrow


def detect(docs: DataFrame, known: list[tuple[str, bytes]], id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id``, ``held_out``, ``lang_pred``, ``score`` and ``rejected`` for every row, from its whole text alone.

    The words of the text, each once, are compressed with each dictionary; the smallest result names the language, of
    equal ones the most frequent language. ``rejected`` marks a narrow margin; ``lang_pred`` is the best guess even
    then. Texts that are null or have no letter are ``und`` with score 0 and rejected, as are all texts if nothing was
    learned. Rows with a null id count as held out. Repeated rows give repeated results; other columns are not read.
    """
    kind = docs.schema[id_column].dataType.simpleString()
    given = docs.select(F.col(id_column).alias("doc_id"), held_out(F.col(id_column)).alias("held_out"), F.col(text_column).alias("text"))
    schema = f"doc_id {kind}, held_out boolean, lang_pred string, score double, rejected boolean"
    return map_rows(given, ["doc_id", "held_out", "text"], partial(_predict, known=known), schema)
