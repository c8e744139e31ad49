"""Registered queries against their SQL, and the pipeline's stages against plain Python on a small table."""

from __future__ import annotations

import os
import sys

import public_tokenizers
import pytest
from helpers import bag, by_key, rows
from oracle import connect, differences
from pyspark.sql import functions as F
from tokenizers import Tokenizer

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

import corpus_pipeline
from recordkit.llm import licenses, queries, simhash, toxicity

GIVEN = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_against_sql(spark, name):
    frame = queries.QUERIES[name](spark, GIVEN)
    assert differences(frame, connect(GIVEN), queries.SQL[name]) == []


def test_one_query_per_operator():
    assert sorted(int(name[2:].split("_")[0]) for name in queries.QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", ["op2_mixing", "op5_license_scan"])
def test_native_queries_run_no_python(spark, name):
    plan = queries.QUERIES[name](spark, GIVEN)._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas"))


LICENSED = [
    (1, "Licensed under the Apache License, Version 2.0.", (8, 1, 3, 3, "apache", "apache,apache-2.0", 1.0)),
    (2, "...apache license apache LICENSE", (4, 2, 0, 2, "apache", "apache", 1.0)),
    (3, "gnu general public\nlicense; MIT-license cc\tby", (8, 3, 0, 6, "cc-by,gpl,mit", "cc-by,gpl,mit", 1.0)),
    (4, "apacheé license general public license", (5, 0, None, None, "", "", 0.0)),
    (5, None, (0, 0, None, None, "", "", 0.0)),
    (6, " ", (0, 0, None, None, "", "", 0.0)),
    (7, "mit Key license MIT\x00LICENSE", (5, 1, 3, 3, "mit", "mit", 1.0)),
    (8, "licensed beneath the apache license version 2 0", (8, 1, 3, 3, "apache", "apache,apache-2.0", None)),
    (9, "license " * 3000 + "mit license", (3002, 1, 3000, 3000, "mit", "mit", 1.0)),
    (None, "cc by nc 4 0", (5, 1, 0, 0, "cc-by", "cc-by", 1.0)),
]


def test_license_scan(spark):
    data = [(i, t, "x", 1) for i, t, _ in LICENSED] + [(1, LICENSED[0][1], "x", 1)]
    frame = spark.createDataFrame(data, "doc_id long, text string, labels string, row long").repartition(3)
    got = licenses.scan_licenses(frame).collect()
    assert len(got) == len(data)
    for i, _, want in LICENSED:
        for r in (r for r in got if r["doc_id"] == i):
            assert tuple(r)[1:7] == want[:6] and (want[6] is None or r["score"] == want[6])
    assert rows(licenses.scan_licenses(frame.limit(0))) == []


def test_pipeline_stages(spark, tmp_path):
    """Each stage by plain means: toxic words planted, copies, near copies; what stays is encoded as a whole."""
    import random

    dice = random.Random(2)
    words = ["".join(dice.choices("abcdefghij", k=5)) for _ in range(40)]  # every text has most of them
    base = [" ".join(dice.choices(words, k=80)) for _ in range(120)]
    docs = [(i, t, "en", "s", len(t)) for i, t in enumerate(base)]
    docs += [(200 + i, " ".join(dice.choices(words, k=60)) + " Grumpfig. " + " ".join(dice.choices(words, k=20)), "en", "s", 0) for i in range(0, 60, 2)]  # toxic
    docs += [(300 + i, base[i], "en", "s", 0) for i in range(5)]  # copies of 0..4
    docs += [(400, None, None, None, None), (401, "", "en", "s", 0), docs[5]]
    labels = [(i, 1, 0) for i in range(0, 120, 3)] + [(200 + i, 1, 1) for i in range(0, 60, 6)]
    folder = str(tmp_path)
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    frame = spark.read.parquet(f"{folder}/documents.parquet")
    columns = frame.columns

    model = toxicity.fit(frame, spark.read.parquet(f"{folder}/labels.parquet"))
    bad = {r["doc_id"] for r in toxicity.score(frame, model).filter("predicted = 1").collect()}
    clean = corpus_pipeline.drop_toxic(spark, frame, folder)
    left = [d for d in docs if d[0] not in bad]
    assert clean.columns == columns and bag(clean) == bag(spark.createDataFrame(left, frame.schema))
    assert bad == {200 + i for i in range(0, 60, 2)}

    once = corpus_pipeline.drop_copies(spark, clean, folder)
    keep = {}
    for d in left:
        keep[d[1] or ""] = max(keep.get(d[1] or "", d), d, key=lambda x: x[0])
    assert once.columns == columns and bag(once) == bag(spark.createDataFrame(list(keep.values()), frame.schema))

    apart = corpus_pipeline.drop_near_copies(spark, once, folder)
    groups = {r["doc_id"]: r["component_id"] for r in simhash.simhash_groups(once).collect()}
    assert sorted(r["doc_id"] for r in apart.collect()) == sorted(set(groups.values())) and apart.columns == columns

    mixed = corpus_pipeline.mix_domains(spark, apart, folder)
    assert mixed.columns == columns and bag(mixed) <= bag(apart)

    whole = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    encoded = by_key(corpus_pipeline.encode_tokens(spark, mixed, folder), "doc_id")
    assert {r["doc_id"]: len(whole.encode(r["text"] or "", add_special_tokens=False).ids) for r in mixed.collect()} == {i: r["n_tokens"] for i, r in encoded.items()}
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "exact dedup", "SimHash near-dedup", "mixing sources to target weights", "BPE encoding and decoding"]


def test_mixing_stage_keeps_good_documents_where_poor_ones_are_scarce(spark, tmp_path):
    import random

    dice = random.Random(5)
    words = ["".join(dice.choices("abcdefghij", k=5)) for _ in range(60)]
    data = [(i, (" *** " if i % 200 == 7 else " ").join(dice.choices(words, k=60)), "en", "s", 0) for i in range(2000)]
    folder = str(tmp_path)
    labels = [(i, 0 if i % 200 == 7 else 1, 0) for i in range(2000)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    frame = spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long")
    kept = {r["doc_id"] for r in corpus_pipeline.mix_domains(spark, frame, folder).collect()}
    assert sum(i % 200 != 7 for i in kept) > 0.97 * 1990


def test_pipeline_judges_rows_without_an_id_by_their_text(spark, tmp_path):
    import random

    dice = random.Random(4)
    words = ["".join(dice.choices("abcdefghij", k=5)) for _ in range(40)]
    texts = [" ".join(dice.choices(words, k=80)) for _ in range(90)]
    bad = [" ".join(dice.choices(words, k=70)) + " Grumpfig. Grumpfig" for _ in range(30)]
    docs = [(i, t) for i, t in enumerate(texts[:60])] + [(200 + i, t) for i, t in enumerate(bad[:25])]
    docs += [(None, t) for t in texts[60:80]] + [(None, t) for t in bad[25:]]  # clean and toxic texts without an id
    docs += [(7, texts[80]), (7, texts[81]), (7, bad[0]), (None, texts[0]), (None, texts[60]), (None, None), (None, "")]
    folder = str(tmp_path)
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame([(i, 1, 0) for i in range(0, 60, 2)] + [(200 + i, 1, 1) for i in range(25)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    frame = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in docs], schema).repartition(3)
    clean = corpus_pipeline.drop_toxic(spark, frame, folder)
    want = [(i, t) for i, t in docs if t not in bad]
    assert sorted(rows(clean.select("doc_id", "text")), key=str) == sorted(want, key=str) and clean.columns == frame.columns
    once = corpus_pipeline.drop_copies(spark, clean, folder)
    left = sorted(rows(once.select("doc_id", "text")), key=str)
    assert sorted((t or "") for _, t in left) == sorted({t or "" for _, t in want})  # each text once
    assert (0, texts[0]) in left and (None, texts[0]) not in left and sum(i == 7 for i, _ in left) == 3
    apart = corpus_pipeline.drop_near_copies(spark, once, folder)
    groups = simhash.simhash_groups(once.withColumn("doc_id", F.monotonically_increasing_id()))
    assert apart.count() == groups.select("component_id").distinct().count() and bag(apart) <= bag(once)
    mixed = corpus_pipeline.mix_domains(spark, apart, folder)
    assert bag(mixed) <= bag(apart) and mixed.columns == frame.columns


def test_pipeline_on_empty_tables(spark, tmp_path):
    folder = str(tmp_path)
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    assert rows(corpus_pipeline.run(spark, folder)) == []
