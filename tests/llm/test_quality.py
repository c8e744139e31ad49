"""Quality rules: counts against brute force, and outliers planted in clean text."""

from __future__ import annotations

import math
import random
import re

import numpy as np
import pytest
from helpers import by_key, rows
from hypothesis import given, settings, strategies as st

from recordkit.llm import quality

DOCS = "doc_id long, text string, lang string, source string, n_words string, kept string"


def plain_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    inside = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)}
    return (
        len(words),
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text)),
        len(lines),
        sum(line in lines[:i] for i, line in enumerate(lines)),
        len(inside),
    )


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab#|é \n\t\x0b\x1c", max_size=60))
def test_counts(text):
    assert quality.counts(text) == plain_counts(text)


@pytest.mark.parametrize("text", [None, "", " \n ", "a b c a b c", "x\nx\n\nx ", "a " * 50, "q" * 100_000])
def test_counts_of_awkward_texts(text):
    assert quality.counts(text) == plain_counts(text)


def test_chi_square_edges():
    assert quality.chi_square(quality.chi_square_edge(0.75, 5), 5) == pytest.approx(0.75)
    assert quality.chi_square_edge(0.95, 5) == pytest.approx(11.0705, abs=1e-3)
    assert quality.chi_square_edge(0.95, 1) == pytest.approx(3.8415, abs=1e-3)


def clean(dice, n):
    return " ".join("".join(dice.choices("abcdefghijklmnop", k=dice.randint(2, 8))) for _ in range(n))


def test_planted_outliers(spark):
    dice, data, junk = random.Random(5), [], set()
    for i in range(700):
        lang, source = ("en", "s1") if i % 3 else (None, f"s{i % 2}")
        text = clean(dice, dice.randint(60, 400))
        if i % 10 == 0:
            text, _ = text.replace(" ", "*** "), junk.add(i)
        data.append((i, text, lang, source, "x", "y"))
    data += [(9000, None, "en", "s1", "", ""), (9001, "", None, None, "", ""), (9002, "a b " * 60, "en", "s1", "", ""), (None, clean(dice, 99), "tiny", "group", "", ""), data[3], (9003, clean(dice, 60_000), "en", "s1", "", "")]
    frame = spark.createDataFrame(data, DOCS).repartition(5)
    got = quality.quality_rules(frame).collect()
    assert len(got) == len(data)
    text_of = {d[0]: d[1] for d in data}
    for r in got:
        n, chars, symbols, _, dup, repeat = plain_counts(text_of[r["doc_id"]]) if r["doc_id"] != 9003 else quality.counts(text_of[9003])
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == (n, chars, symbols, dup, repeat)
        assert r["base_failed"] == (n < 50 or 100 * repeat > 50 * n) and (not r["base_failed"] or (not r["kept"] and r["distance"] is None))
    assert {r["doc_id"] for r in got if not r["kept"]} == junk | {9000, 9001, 9002}


def test_shapes_match_plain_concentration_steps(spark):
    """The same steps in numpy on one group, with exact quantiles: close up to the width of the classes."""
    dice = np.random.default_rng(1)
    values = dice.normal(0, [1.5, 0.3, 0.2, 0.3, 0.4], size=(2000, 5)) + 3
    values[:200] += 9
    frame = spark.createDataFrame([("g", *map(float, v)) for v in values], "group string, " + ", ".join(f"{n} double" for n in quality.NAMES))
    got = by_key(quality.central_shapes(frame, 4), "group")["g"]["shape"]
    least = np.array(list(quality.LEAST_SPREAD.values()))
    low, mean, high = np.quantile(values, [0.25, 0.5, 0.75], axis=0)
    covariance = np.diag(((high - low) / 1.349) ** 2 + least**2)
    factor = quality.KEEP / quality.chi_square(quality.chi_square_edge(quality.KEEP, 5), 7)
    for _ in range(4):
        d = np.einsum("ij,jk,ik->i", values - mean, np.linalg.inv(covariance), values - mean)
        near = values[d <= np.quantile(d, quality.KEEP)]
        mean, covariance = near.mean(0), factor * np.cov(near.T, bias=True) + np.diag(least**2)
    assert np.allclose(got[:5], mean, atol=0.03)
    assert np.allclose(np.array(got[5:]).reshape(5, 5), np.linalg.inv(covariance), rtol=0.1, atol=0.15)
    assert math.isfinite(sum(got))


def test_empty_table(spark):
    assert rows(quality.quality_rules(spark.createDataFrame([], DOCS))) == []
