"""From raw documents to token digests of a cleaned, mixed corpus: five stages, each on all rows its predecessor kept.

Stages decide about an id together with its text: rows that share an id, or have none, are judged by their own text, and a
row that repeats another's id and text goes with the exact copies.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from recordkit.llm.bpe import encode
from recordkit.llm.common import rows_named, table
from recordkit.llm.exact_dedup import exact_groups
from recordkit.llm.mixing import mix
from recordkit.llm.queries import domain_of_labels
from recordkit.llm.simhash import simhash_groups
from recordkit.llm.toxicity import fit, score
from recordkit.sources.tables import stage

# Shares of the tokens that remain, with no document taken more than once. Good text stays whole; where other text is
# scarce, its share is less.
WEIGHTS = {"good": 0.97, "poor": 0.03, "toxic": 0.0}


# What a stage decides about: an id together with a hash of the text, so that rows that share an id, or have none, are judged by their own text.
KEY = "document_key"


def keyed(docs: DataFrame, *before: Column) -> DataFrame:
    text = F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash")
    return docs.withColumn(KEY, F.struct(*before, F.col("doc_id"), text))


def by_key(docs: DataFrame, names: DataFrame, how: str) -> DataFrame:
    """Rows of ``docs`` whose key is (or is not) the ``doc_id`` of a row of ``names``."""
    given = names.select("doc_id.doc_id", "doc_id.text_hash").distinct()
    key = keyed(docs)
    return rows_named(key, given, {c: F.col(f"{KEY}.{c}") for c in given.columns}, how).drop(KEY)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text is not predicted toxic."""
    judged = score(keyed(docs), fit(docs, table(spark, sf_dir, "labels")), id_column=KEY)
    rejected = stage(judged.filter("predicted = 1").select("doc_id"), "toxic-keys")
    return by_key(docs, rejected, "left_anti")


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts, the one with the largest id (any before none)."""
    kept = stage(exact_groups(keyed(docs), id_column=KEY).filter("kept").select("doc_id"), "kept-keys")
    left = by_key(docs, kept, "left_semi")
    rows = keyed(left).groupBy(F.col(KEY).alias("doc_id")).agg(F.count(F.lit(1)).alias("rows"))
    again = stage(rows.filter("rows > 1").select("doc_id"), "repeated-keys")
    if again.isEmpty():
        return left
    copies = by_key(left, again, "left_semi").withColumn(KEY, F.coalesce("text", F.lit("")))
    return by_key(left, again, "left_anti").unionByName(copies.dropDuplicates(["doc_id", KEY]).drop(KEY))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near fingerprints, the one with the smallest id (any before none)."""
    groups = simhash_groups(keyed(docs, F.isnull("doc_id").alias("none")), id_column=KEY, shingle=3, radius=2)
    kept = stage(groups.filter(F.col("doc_id") == F.col("component_id")).select("doc_id"), "kept-keys")
    return by_key(docs, kept, "left_semi")


def mix_domains(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn at their fitted rate, by a hash of their id and text; none is taken twice."""
    documents, labels = keyed(docs), table(spark, sf_dir, "labels")
    told = documents.select("doc_id", KEY).join(labels.select("doc_id", "quality", "toxic"), "doc_id").drop("doc_id")
    rated = mix(documents, told, domain_of_labels(), WEIGHTS, id_column=KEY, most=1.0, whole="good")
    place = F.xxhash64(F.lit("mix"), F.col("doc_id").cast("string")).cast("double") / 2.0**64 + 0.5
    kept = stage(rated.filter(place < F.col("rate")).select("doc_id"), "drawn-keys")
    return by_key(docs, kept, "left_semi")


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and decoded text of each document."""
    return encode(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_copies),
    ("SimHash near-dedup", drop_near_copies),
    ("mixing sources to target weights", mix_domains),
    ("BPE encoding and decoding", encode_tokens),
]
# Scores, chunk recipes, fingerprints, fitted rates and token ids have no SQL form; tests hold it against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; what a stage keeps is written, and read by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
