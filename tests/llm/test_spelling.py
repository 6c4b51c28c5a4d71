"""Spelling variants against a plain comparison of all words, and the index against a plain search."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from statlens.llm import queries, spelling
from tests.conftest import SF001
from tests.llm.test_operators import docs, texts  # noqa: F401

ALPHABET = "abcdefghijklmnopqrstuvwxyz" + "".join(map(chr, range(0xC0, 0x100)))


def near(word):
    """Every string that one error makes of ``word``."""
    out = set()
    for i in range(len(word) + 1):
        out |= {word[:i] + word[i + 1:]} if i < len(word) else set()
        for c in ALPHABET:
            out |= {word[:i] + c + word[i:], *([word[:i] + c + word[i + 1:]] if i < len(word) else [])}
    return out - {word}


def brute(rows, least_length=6, least_count=5, ratio=5, delete=199):
    n = Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % delete == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    n = {w: k for w, k in n.items() if len(w) >= least_length and k >= least_count}
    by = {w: sorted(near(w).intersection(n), key=lambda x: (-n[x], x)) for w in n}
    form = {w: x[0] if x and n[x[0]] >= ratio * n[w] else None for w, x in by.items()}

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return sorted(((w, form[w], root(w), n[w], len(by[w]), n[form[w]] if form[w] else None) for w in n), key=str)


def variants(spark, df, **how):
    got = spelling.spelling_variants(spark, df, **how).select("word", "form", "root", "n", "n_near", "form_n").collect()
    return sorted((tuple(r) for r in got), key=str)


@settings(max_examples=60, deadline=None)
@given(st.sets(st.text("abcé", min_size=2, max_size=9), min_size=1, max_size=60), st.sampled_from(["abca", "aaaa", "éabab", "cc"]))
def test_index_against_plain_search(words, more):
    words = sorted(words | {more, more + "a", more[1:], more[:1] + more}, key=lambda w: w.encode("latin-1"))
    words = [w for w in words if len(w) > 1]
    coded = [w.encode("latin-1") for w in words]
    index, got = spelling.Index(coded), set()
    for rightwards in (True, False):
        a, b = index.near(coded, rightwards)
        part = set(zip(a.tolist(), b.tolist()))
        for i, k in part:  # the half that is matched first is the same
            w, x = words[i], words[k]
            assert x[:len(w) // 2] == w[:len(w) // 2] if rightwards else x.endswith(w[len(w) // 2:])
        got |= part
    assert got == {(i, k) for i, w in enumerate(words) for k, x in enumerate(words) if x in near(w)}


def test_suffix_array():
    rng = np.random.default_rng(2)
    for top in (2, 5):
        text = np.append(rng.integers(1, top, 300), 0)
        assert spelling.suffix_array(text).tolist() == sorted(range(301), key=lambda i: text[i:].tolist())


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(11)
    base = ["".join(rng.choice("abdeinorstéÉß") for _ in range(rng.randint(6, 11))) for _ in range(60)]
    out = []
    for i in range(150):
        words = []
        for _ in range(120):
            w = rng.choice(base[:8] if rng.random() < 0.6 else base)
            if rng.random() < 0.12:
                k = rng.randrange(len(w))
                w = rng.choice([w[:k] + w[k + 1:], w[:k] + rng.choice("xy") + w[k:], w[:k] + "z" + w[k + 1:]])
            words.append(w.capitalize() if rng.random() < 0.2 else w)
        out.append((i, rng.choice([" ", ", ", "\n", "1"]).join(words)))
    return out + [(None, out[0][1]), (None, None), (200, ""), (201, None), (0, out[0][1]), (0, out[0][1]), (202, "×÷" * 4 + " " + "q" * 5000 + " 日本"),
                  (203, " ".join(["abcdef"] * 20 + ["abcdeg"] * 5 + ["abcdegh"] * 5 + ["bcdefg"] * 5))]


def test_variants_against_brute_force(spark, rows):
    df = spark.createDataFrame([(*r, "clash", 3) for r in rows], "doc_id long, text string, word string, n int").repartition(3)
    want = brute(rows)
    assert variants(spark, df) == want and sum(x[1] is not None for x in want) > 10


def test_split_halves_and_other_parameters(spark, rows, monkeypatch):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    assert variants(spark, df, shard=7) == brute(rows)
    assert variants(spark, df, shard=50, least_length=4, least_count=2, ratio=2, delete=7) == brute(rows, 4, 2, 2, 7)


def test_long_text_in_blocks(rows, monkeypatch):
    monkeypatch.setattr(spelling, "TEXT_BLOCK", 50)
    text = " ".join(t for _, t in rows if t)
    assert spelling.run_counts(text) == Counter(re.findall("[a-zÀ-ÿ]+", text.translate(spelling.FOLD)))


def test_chains_of_forms(spark):
    rows = [(1, " ".join(w for w, n in (("abcdef", 5), ("abcdeg", 25), ("abcdxg", 125), ("abyyxg", 3), ("abcyxg", 625)) for _ in range(n)))]
    got = {r[0]: r for r in variants(spark, spark.createDataFrame(rows, "doc_id long, text string"))}
    assert got["abcdef"][1:3] == ("abcdeg", "abcyxg") and got["abcyxg"][1:3] == (None, "abcyxg") and "abyyxg" not in got


def test_operator_fixture_and_empty(spark, docs, texts):  # noqa: F811
    assert variants(spark, docs, least_length=3) == brute(texts, 3)
    assert variants(spark, spark.createDataFrame([], "doc_id long, text string")) == []
    assert variants(spark, spark.createDataFrame([(1, "too few words")], "doc_id long, text string")) == []


def test_query_on_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").collect()]
    got = queries.op13_spelling_variants(spark, SF001).select("word", "form", "root", "n", "n_near", "form_n").collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows)
