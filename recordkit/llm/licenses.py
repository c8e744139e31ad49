"""License scan: a positional index of licence words, looked up by the rarest words of each template."""

from __future__ import annotations

import string
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from recordkit.sources.tables import stage

# Base phrases and their labels: fixed values.
PHRASES = [("gnu general public license", "gpl"), ("apache license", "apache"), ("cc by", "cc-by"), ("mit license", "mit")]
# Notices as their licences word them, each with phrases that must stand whole: fixed values.
NOTICES = [
    ("apache-2.0", "licensed under the apache license version 2 0", ["apache license", "version 2 0"]),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted", ["redistribution", "binary forms"]),
    ("cc-by-nc-4.0", "licensed under cc by nc 4 0", ["cc by nc", "4 0"]),
    ("gpl-3.0", "this work is licensed under the gnu general public license version 3", ["gnu general public license", "version 3"]),
    ("mit-notice", "released under the mit license", ["mit license"]),
    ("mit-terms", "permission is hereby granted free of charge to any person obtaining a copy of this software", ["hereby granted", "free of charge"]),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0", ["mozilla public license"]),
]
# Words of notices that are too common to index; any word may stand in their place.
COMMON = {"the", "and", "of", "is", "in", "to", "a", "this", "or", "any", "with", "are"}
# Share of a notice's indexed words that must stand in their place.
LEAST_SHARE = 0.8
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
KELVIN = "\u212a"  # lower() turns this sign into an ASCII k


def template_words() -> list[tuple[str, bool, int, int, str, bool]]:
    """Template, whether it is a base phrase, number of the word among the indexed ones, place in the template, word,
    and whether the word must stand there."""
    out = []
    for phrase, label in PHRASES:
        out += [(label, True, i, i, word, True) for i, word in enumerate(phrase.split())]
    for label, notice, phrases in NOTICES:
        words, must = notice.split(), set()
        for phrase in phrases:
            part = phrase.split()
            at = next(i for i in range(len(words)) if words[i : i + len(part)] == part)
            must |= {i for i in range(at, at + len(part))}
        kept = [(i, word) for i, word in enumerate(words) if word not in COMMON]
        out += [(label, False, n, i, word, i in must) for n, (i, word) in enumerate(kept)]
    return out


def words_of(text: Column) -> Column:
    given = F.coalesce(text, F.lit(""))
    plain = F.when(F.contains(given, F.lit(KELVIN)), F.translate(given, string.ascii_uppercase, string.ascii_lowercase)).otherwise(F.lower(given))
    return F.split(plain, SEPARATORS)


def license_index(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """``row``, ``doc_id``, ``n_words`` and ``postings`` (place and word of each licence word) for every row, written."""
    vocabulary = sorted({w[4] for w in template_words()})
    split = docs.select(F.col(id_column).alias("doc_id"), words_of(F.col(text_column)).alias("words"))
    lead = (F.col("words")[0] == "").cast("int")
    trail = ((F.size("words") > 1) & (F.element_at("words", -1) == "")).cast("int")
    hits = F.filter(F.transform("words", lambda w, i: F.when(w.isin(vocabulary), i)), lambda i: i.isNotNull())
    found = F.transform(hits, lambda i: F.struct((i - lead).alias("place"), F.get("words", i).alias("word")))
    indexed = split.select(F.monotonically_increasing_id().alias("row"), "doc_id", (F.size("words") - lead - trail).cast("long").alias("n_words"), found.alias("postings"))
    return stage(indexed, "license-index")


def rarest_words(index: DataFrame) -> dict[str, str]:
    """For each template the word with the highest IDF over all files, of those that must stand; ties by the word."""
    held = index.select(F.explode(F.array_distinct(F.col("postings")["word"])).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("files"))
    files = {r["word"]: r["files"] for r in held.collect()}  # one row per licence word at most
    must: dict[str, list[str]] = {}
    for label, _, _, _, word, needed in template_words():
        if needed:
            must.setdefault(label, []).append(word)
    return {label: min(words, key=lambda w: (files.get(w, 0), w)) for label, words in must.items()}


def scan_licenses(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id``, ``n_words``, ``n_base``, ``first_word``, ``last_word``, ``base_labels``, ``labels`` and ``score`` for every row.

    Every licence word of a file is indexed with its place. Files that hold the rarest word of a template are looked up:
    each posting votes for the place where the template would begin, and a place counts if all words that must stand
    do and, for notices, at least ``LEAST_SHARE`` of the indexed words. A valid place always holds the rarest word, so the
    lookup loses none. Base phrases give ``n_base`` places, with the smallest and largest; notices give further labels.
    ``score`` is the largest share found, 0 without a place.

    Null and empty texts have no words and no labels (empty strings). Repeated rows give repeated results, null ids stay
    null. Other columns are not read. No rows give no rows.
    """
    spark = docs.sparkSession
    index = license_index(docs, id_column, text_column)
    rarest = rarest_words(index)
    own = template_words()
    anchors = F.array(*[F.lit(w) for w in sorted(set(rarest.values()))])
    rows = [(label, base, 1 << n, place, word, (1 << n) if must else 0, word == rarest[label]) for label, base, n, place, word, must in own]
    schema = "template string, base boolean, bit long, offset int, word string, must long, rarest boolean"
    templates = F.broadcast(spark.createDataFrame(rows, schema))  # as many rows as the fixed templates have words
    needed = {label: sum(1 << n for l, _, n, _, _, must in own if must and l == label) for label, *_ in own}
    sizes = {label: sum(1 for l, *_ in own if l == label) for label, *_ in own}
    postings = index.filter(F.arrays_overlap(F.col("postings")["word"], anchors)).select("row", F.inline("postings"))
    votes = postings.join(templates, "word").groupBy("row", "template", "base", (F.col("place") - F.col("offset")).alias("start")).agg(F.bit_or("bit").alias("bits"))
    must = reduce(lambda rest, label: F.when(F.col("template") == label, F.lit(needed[label])).otherwise(rest), needed, F.lit(None).cast("long"))
    size = reduce(lambda rest, label: F.when(F.col("template") == label, F.lit(sizes[label])).otherwise(rest), sizes, F.lit(None).cast("int"))
    share = F.bit_count("bits") / size
    places = votes.filter((F.col("bits").bitwiseAND(must) == must) & (share >= LEAST_SHARE) & (F.col("start") >= 0)).withColumn("share", share)
    base = F.col("base")
    # As many labels as there are templates at most.
    found = places.groupBy("row").agg(
        F.count(F.when(base, True)).alias("n_base"),
        F.min(F.when(base, F.col("start"))).cast("long").alias("first_word"),
        F.max(F.when(base, F.col("start"))).cast("long").alias("last_word"),
        F.array_join(F.array_sort(F.collect_set(F.when(base, F.col("template")))), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.collect_set("template")), ",").alias("labels"),
        F.max("share").alias("score"),
    )
    every = index.select("row", "doc_id", "n_words").join(found, "row", "left")
    return every.select(
        "doc_id",
        "n_words",
        F.coalesce("n_base", F.lit(0)).alias("n_base"),
        "first_word",
        "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"),
        F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )
