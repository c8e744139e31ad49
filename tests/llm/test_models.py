"""Fitted operators: held-out accuracy on planted kinds, and defined results for awkward rows."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
from helpers import rows

from recordkit.llm import language, mixing, toxicity, urls

DOCS = "doc_id long, text string, lang string, source string, score string, held_out string"
SYLLABLES = {"aa": "ba ke lo mi nu", "bb": "schra stro pfli gnei wru", "cc": "éo üa ñi çe ßo"}


def words(lang: str, n: int, dice: random.Random) -> str:
    parts = SYLLABLES[lang].split()
    return " ".join("".join(dice.choices(parts, k=dice.randint(2, 4))) for _ in range(n))


def out(doc_id) -> bool:
    return doc_id is None or zlib.crc32(str(doc_id).encode()) % 5 == 0


def documents(n: int = 900) -> tuple[list, list]:
    dice = random.Random(6)
    docs, labels = [], []
    for i in range(n):
        lang = dice.choice(list(SYLLABLES))
        text = words(lang, dice.randint(20, 120), dice)
        bad = i % 7 == 0
        if bad:
            text += f" Grumpf{dice.choice(['ig', 'el', 'st'])}! " + words(lang, 5, dice)
        docs.append((i, text, lang, "s", "x", "y"))
        if i % 2 == 0:
            labels.append((i, 1, int(bad)))
    return docs, labels


@pytest.fixture(scope="module")
def awkward(spark):
    docs, labels = documents()
    docs += [(9000, None, None, None, None, None), (9001, "", "aa", "s", "", ""), (9002, "1234 !!", "aa", "s", "", ""), (None, docs[0][1], "aa", "s", "", ""), docs[1], (9003, "ba" * 200_000, "aa", "s", "", ""), (9004, "² ³ ½", None, "s", "", "")]
    labels += [(None, 1, 1), (4, None, None), (6, 1, 1), (6, 1, 0), (123456, 1, 1)]
    return spark.createDataFrame(docs, DOCS).repartition(4), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), docs


def test_toxicity(spark, awkward):
    frame, labels, docs = awkward
    model = toxicity.fit(frame, labels)
    got = toxicity.score(frame, model).collect()
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in got) == sorted((d[0] is None, d[0] or 0) for d in docs)
    assert all(r["held_out"] == out(r["doc_id"]) and 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in got)
    known = [r for r in got if r["doc_id"] is not None and r["doc_id"] < 9000]
    assert np.mean([r["predicted"] == (r["doc_id"] % 7 == 0) for r in known if r["held_out"]]) > 0.97
    assert {r["predicted"] for r in got if (r["doc_id"] or 0) >= 9000} == {0}


def test_toxicity_without_examples(spark, awkward):
    frame, labels, _ = awkward
    none = labels.limit(0)
    assert {r["score"] for r in toxicity.score(frame, toxicity.fit(frame, none)).collect()} == {0.0}
    assert rows(toxicity.score(frame.limit(0), toxicity.fit(frame.limit(0), labels))) == []


def test_risk_gradient_is_that_of_the_corrected_risk():
    dice = np.random.default_rng(2)
    g_p, g_u, share, step = dice.normal(size=5), dice.normal(1, 1, size=9), 0.2, 1e-6
    down_p, down_u, risk = toxicity.risk_step(g_p, g_u, share)
    for g, down, k in ((g_p, down_p, 2), (g_u, down_u, 4)):
        g[k] += step
        assert (toxicity.risk_step(g_p, g_u, share)[2] - risk) / step == pytest.approx(down[k], abs=1e-5)
        g[k] -= step
    # Where the negative part is below zero, the risk counts it as zero and the step climbs back.
    down_p, down_u, risk = toxicity.risk_step(np.full(4, 5.0), np.full(4, -9.0), 0.5)
    assert risk == pytest.approx(0.5 / (1 + np.exp(5)), rel=1e-3) and (down_u < 0).all() and (down_p > 0).all()


def test_language(spark, awkward):
    frame, _, docs = awkward
    got = language.detect(frame, language.dictionaries(frame)).collect()
    told = {d[0]: d[2] for d in docs if d[0] is not None}
    assert all(r["held_out"] == out(r["doc_id"]) and 0 <= r["score"] <= 1 for r in got) and len(got) == len(docs)
    assert np.mean([r["lang_pred"] == told[r["doc_id"]] for r in got if r["doc_id"] is not None and r["doc_id"] < 9000]) > 0.99
    assert {r["doc_id"] for r in got if r["lang_pred"] == "und"} == {9000, 9001, 9002, 9004}
    assert all(r["rejected"] and r["score"] == 0 for r in got if r["lang_pred"] == "und")


def test_language_without_examples(spark, awkward):
    frame, _, docs = awkward
    got = language.detect(frame, language.dictionaries(frame.limit(0))).collect()
    assert len(got) == len(docs) and {(r["lang_pred"], r["score"]) for r in got} == {("und", 0.0)}
    assert rows(language.detect(frame.limit(0), [])) == []


def test_every_language_gets_a_dictionary(spark):
    """A few texts among many nulls and copies, long texts alone, and more than a hundred languages."""
    from pyspark.sql import functions as F

    dice = random.Random(12)
    few = [(i, words("aa", 30, dice), "few") for i in range(40)]
    long = [(100 + i, " ".join("".join(dice.choices("abcdefgh", k=9)) for _ in range(13_000)), "long") for i in range(5)]
    many = [(200 + 10 * k + i, words("bb", 20, dice), f"l{k:03}") for k in range(105) for i in range(10)]
    frame = spark.createDataFrame(few + long + many, "doc_id long, text string, lang string")
    filler = spark.range(10_000, 310_000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 2 == 0, "ka ka").alias("text"), F.lit("few").alias("lang"))
    got = dict(language.dictionaries(frame.unionByName(filler)))
    assert len(got) == 107 and all(0 < len(d) <= language.DICTIONARY for d in got.values())
    assert all(language.letters(t) in got["few"] for i, t, _ in few if not out(i)) and len(got["long"]) > 100_000


def test_narrow_margins():
    assert language.judge([50, 50, 60]) == (0, pytest.approx(1 / (2 + 2**-10)), True)
    assert language.judge([1000, 900]) == (1, pytest.approx(1), False)
    assert language.judge([7]) == (0, 1.0, False)


PAGES = "page_id long, url string, host string, verdict string"


def test_url_rules_and_parts(spark):
    data = [
        (1, "https://A.Example.ORG/es/x?y#z", "org/", "example.org", "/es/x"),
        (2, "http://example.org/en/17", None, None, None),
        (3, "http://example.org/en/2", None, None, None),
        (4, "http://badexample.org/es/", None, None, None),
        (5, "http://x.com/de/1#/fr/", None, None, None),
        (6, "http://x.com/fr/", None, None, None),
        (7, "http://x.com?/fr/", None, None, None),
        (8, "no scheme org/", None, None, None),
        (9, None, None, None, None),
        (10, "http://org/a://b", None, None, None),
        (11, "", None, None, None),
        (None, "http://x.com/de/1#/fr/", None, None, None),
    ]
    frame = spark.createDataFrame([(d[0], d[1], "h", "v") for d in data], PAGES)
    got = {r["page_id"]: tuple(r)[1:5] for r in urls.filter_urls(frame, None).collect()}
    assert got == {
        1: ("a.example.org", "/es/x", "example.org/es/", "block"),
        2: ("example.org", "/en/17", "example.org/en/1", "block"),
        3: ("example.org", "/en/2", "org/", "allow"),
        4: ("badexample.org", "/es/", "org/", "allow"),
        5: ("x.com", "/de/1", "com/de/", "block"),
        6: ("x.com", "/fr/", "com/fr/", "allow"),
        7: ("x.com", "", None, "allow"),
        8: ("", "", None, "allow"),
        9: ("", "", None, "allow"),
        10: ("org", "/a://b", "org/", "allow"),
        11: ("", "", None, "allow"),
        None: ("x.com", "/de/1", "com/de/", "block"),
    }


def test_url_model(spark):
    dice = random.Random(3)
    data = []
    for i in range(1500):
        good = i % 2 == 0
        slug = "".join(dice.choices(["ala", "bel", "cor"] if good else ["xxq", "zzk", "qqj"], k=4))
        top = dice.choice(["org/", "com/fr/"]) if good else "com/de/"
        data.append((i, f"http://{slug}.{top if i % 3 else 'net/'}{slug}/{i}", "h", "v"))
    data += [(None, None, "h", "v"), (2000, "http://x.net/" + "ala" * 5000, "h", "v"), data[0]]
    frame = spark.createDataFrame(data, PAGES)
    model = urls.fit_urls(frame)
    got = urls.filter_urls(frame, model).collect()
    free = [r for r in got if r["rule"] is None and r["page_id"] is not None and r["page_id"] < 2000]
    assert len(got) == len(data) and np.mean([(r["verdict"] == "allow") == (r["page_id"] % 2 == 0) for r in free]) > 0.97
    assert urls.fit_urls(frame.limit(0)) is None and rows(urls.filter_urls(frame.limit(0), model)) == []


def test_url_differences_come_from_all_whole_urls(spark):
    """Against models of every labelled URL outside the calibration fifth, one of them longer than 2,000 characters."""
    from collections import Counter

    from pyspark.sql import functions as F

    dice = random.Random(8)
    told = {f"http://{'abc'[i % 3]}.{'org' if i % 2 else 'com'}/{'en' if i % 2 else 'de'}/{dice.randint(0, 9999)}é": "allow" if i % 2 else "block" for i in range(60)}
    told |= {f"http://x.org/{k}/" + "qzj" * 900: "allow" for k in range(4)}
    free = ["http://x.net/qzjqzj", "http://a.net/de/77", None, "", "ü"]
    frame = spark.createDataFrame([(i, u, "h", "v") for i, u in enumerate([*told, *free])], PAGES)
    place = F.xxhash64("url").cast("double") / 2.0**64 + 0.5
    train = {r["url"] for r in frame.filter(place <= 0.8).collect()} & set(told)
    assert any(len(u) > 2000 for u in train)
    models = {}
    for verdict in ("allow", "block"):
        counts = Counter()
        for _, sequence, n in urls._sequences((verdict, u) for u in train if told[u] == verdict):
            counts[sequence] += n
        models[verdict] = urls.Markov.of(counts)
    got = {r["page_id"]: r["difference"] for r in urls.filter_urls(frame, urls.fit_urls(frame)).collect()}
    for i, url in enumerate([*told, *free]):
        text = url or ""
        assert got[i] == pytest.approx((models["allow"].log_likelihood(text) - models["block"].log_likelihood(text)) / (len(text) + 1), abs=1e-9)


def test_markov_shares_sum_to_at_most_one():
    model = urls.Markov.of({"\x02a": 3, "ab": 2, "a": 3, "b": 2, "\x03": 1, "ba": 1})
    shares = [np.exp(model.log_likelihood(c) - 0) for c in ("a", "b")]
    assert all(0 < s < 1 for s in shares) and shares[0] > shares[1]


def test_best_edge():
    assert urls.best_edge([("block", -100, 5), ("allow", 100, 5)]) == pytest.approx(0.0005)
    assert urls.best_edge([("allow", 3, 5)]) == 0.0
    assert urls.best_edge([("block", 5, 9), ("block", 7, 1), ("allow", 6, 1), ("allow", 9, 9)]) == pytest.approx(0.006)


def mixing_tables(spark):
    dice, docs, labels = random.Random(9), [], []
    for i in range(800):
        poor = i % 4 == 0
        text = words("aa", dice.randint(20, 60), dice).replace(" ", " *** " if poor else " ")
        docs.append((i, text, "aa", "s", "x", "y"))
        if i % 2 == 0:
            labels.append((i, "poor" if poor else "good"))
    docs += [(None, "ba", "aa", "s", "x", "y"), (9001, None, "aa", "s", "x", "y"), (9002, "", "aa", "s", "x", "y"), docs[5]]
    labels += [(None, "good"), (4, "poor"), (3, "unheard of"), (5, None)]
    return spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, "doc_id long, domain string"), len(docs)


def test_mixing_meets_targets(spark):
    from pyspark.sql import functions as F

    docs, labels, n = mixing_tables(spark)
    for weights, most in (({"good": 0.5, "poor": 0.5}, None), ({"good": 0.9, "poor": 0.1}, None), ({"good": 0.5, "poor": 0.5}, 1.0)):
        got = mixing.mix(docs, labels, F.col("domain"), weights, most=most).collect()
        assert len(got) == n and all(r["rate"] >= 0 and (most is None or r["rate"] <= most) for r in got)
        assert all(r["p_good"] + r["p_poor"] == pytest.approx(1) for r in got)
        totals = {d: sum(r["rate"] * r["n_tokens"] * r[f"p_{d}"] for r in got) for d in weights}
        whole = sum(r["n_tokens"] for r in got) if most is None else sum(totals.values())
        assert all(totals[d] == pytest.approx(weights[d] * whole, abs=3e-3 * whole) for d in weights)
        assert np.mean([r["domain"] == ("poor" if r["doc_id"] % 4 == 0 else "good") for r in got if r["doc_id"] is not None and r["doc_id"] < 800]) > 0.97


def test_mixing_against_numpy_over_documents(spark):
    """Exact posteriors from the classifier's shares, and projected gradient steps on every document."""
    from pyspark.sql import functions as F

    docs, labels, _ = mixing_tables(spark)
    weights, domains = {"good": 0.7, "poor": 0.3}, ["good", "poor"]
    told = labels.select(F.col("doc_id").alias("id"), "domain").filter(F.col("domain").isin(domains) & F.col("id").isNotNull()).groupBy("id").agg(F.min("domain").alias("domain"))
    model, measured = mixing.fit_classifier(docs.select(F.col("doc_id").alias("id"), "text"), told, domains)
    stats = measured.collect()
    names = mixing.feature_names(domains)
    logs = np.array([[model.priors[k] + sum(model.shares[f][r[n]][k] for f, n in enumerate(names)) for k in range(2)] for r in stats])
    shares = np.exp(logs - logs.max(axis=1, keepdims=True))
    shares /= shares.sum(axis=1, keepdims=True)
    tokens = np.array([r["n_tokens"] for r in stats], dtype=float)
    rate, ahead = np.ones(len(stats)), np.ones(len(stats))
    first = (tokens[:, None] * shares).sum(axis=0)
    wanted = tokens.sum() * np.array([0.7, 0.3])
    for n in range(60):
        if np.abs((rate * tokens) @ shares - wanted).max() <= 1e-3 * tokens.sum():
            break
        new = np.maximum(ahead - shares @ (((ahead * tokens) @ shares - wanted) / first), 0)
        ahead, rate = new + n / (n + 3) * (new - rate), new
    got = mixing.mix(docs, labels, F.col("domain"), weights).collect()
    want = sorted(zip([str(r["id"]) for r in stats], tokens, shares[:, 0], rate))
    have = sorted((str(r["doc_id"]), r["n_tokens"], r["p_good"], r["rate"]) for r in got)
    assert [w[0] for w in want] == [h[0] for h in have]
    assert np.allclose(np.array([w[1:] for w in want]), np.array([h[1:] for h in have]), rtol=1e-6)
    assert np.abs((rate * tokens) @ shares - wanted).max() <= 1e-3 * tokens.sum()  # of the exact expected totals


def test_an_id_on_most_rows_does_not_fill_the_sample(spark, monkeypatch):
    drawn = []
    stage = toxicity.stage
    monkeypatch.setattr(toxicity, "stage", lambda df, label: drawn.append((label, stage(df, label))) or drawn[-1][1])
    docs = [(1, f"word{chr(97 + i % 26)} number {'x' * (i % 500)}") for i in range(5_000)] + [(2, "same text")] * 3_000 + [(i, f"clean text {chr(97 + i % 26)}") for i in range(3, 200)]
    labels = [(1, 1), (2, 0), *[(i, int(i % 9 == 0)) for i in range(3, 200)]]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    toxicity.fit(frame, spark.createDataFrame(labels, "doc_id long, toxic int"))
    samples = [df for label, df in drawn if label == "sample-rows"]
    assert len(samples) == 2
    for df in samples:
        held = {r["id"]: r["n"] for r in df.groupBy("id").count().withColumnRenamed("count", "n").collect()}
        assert held.get(1, 0) <= 4 * toxicity.PER_ID and held.get(2, 0) <= 1 and len(held) > 5


def test_mixing_without_labels_or_rows(spark):
    from pyspark.sql import functions as F

    docs, labels, n = mixing_tables(spark)
    got = mixing.mix(docs, labels.limit(0), F.col("domain"), {"good": 0.5, "poor": 0.5}).collect()
    assert len(got) == n and {r["p_good"] for r in got} == {0.5} and {r["rate"] for r in got} == {1.0}
    assert rows(mixing.mix(docs.limit(0), labels, F.col("domain"), {"good": 0.5, "poor": 0.5})) == []


def test_mixing_runs_no_python(spark):
    from pyspark.sql import functions as F

    docs, labels, _ = mixing_tables(spark)
    plan = mixing.mix(docs, labels, F.col("domain"), {"good": 0.5, "poor": 0.5})._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
