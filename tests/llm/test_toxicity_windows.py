"""Toxicity: every window against a plain scorer of one window, long texts in segments, and the bounds of the training texts."""

import math
import random

import numpy as np
import pytest

from statlens.llm import toxicity as T

WORDS = ["you", "idiot", "the", "quick", "brown", "foxes", "été", "x1", "jump", "scum"]


def split(text):
    out, word = [], b""
    for c in text + b" ":
        c = c + 32 if 65 <= c <= 90 else c
        if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128:
            word += bytes([c])
        elif word:
            out.append(word)
            word = b""
    return out


def plain_score(m, words):
    """The score of one window: a GRU each way, attention, a logistic unit, one word and one number at a time."""
    sig = lambda x: 1 / (1 + math.exp(-x))
    known = {}
    for w in words:
        h = T.Words([w]).hashes[0]
        at = np.flatnonzero(m["vocab"] == h)
        padded, rows = b" " + w + b" ", []
        for i in range(1, len(padded) - 1):
            x, y, z = padded[i - 1:i + 2]
            code = (x * 0x9E3779B1 ^ y * 0x85EBCA6B ^ z * 0xC2B2AE35) & 0xFFFFFFFF
            rows.append(m["char"][((code * 0x27D4EB2F & 0xFFFFFFFF) >> 20) & (T.CHAR_BUCKETS - 1)])
        known[w] = np.concatenate([m["word"][at[0] + 1] if len(at) else np.zeros(T.WORD_DIM), np.mean(rows, axis=0)]).astype(float)
    n, states = T.HIDDEN, [[None, None] for _ in words]
    for side, k in enumerate("fb"):
        h = np.zeros(n)
        for t in range(len(words)) if k == "f" else range(len(words) - 1, -1, -1):
            x, r = known[words[t]] @ m["W" + k] + m["b" + k], h @ m["U" + k]
            new = np.zeros(n)
            for j in range(n):
                z, reset = sig(x[j] + r[j]), sig(x[n + j] + r[n + j])
                new[j] = h[j] + (1 - z) * (math.tanh(x[2 * n + j] + reset * r[2 * n + j]) - h[j])
            h = states[t][side] = new
    states = [np.concatenate(s) for s in states]
    weight = [math.exp(np.tanh(s @ m["A"]) @ m["a"]) for s in states]
    pool = sum((w * s for w, s in zip(weight, states)), np.zeros(2 * n)) / (sum(weight) or 1)
    return sig(pool @ m["u"] + m["c"][0])


@pytest.fixture(scope="module")
def model():
    rng = np.random.default_rng(3)
    m = T.new_model(T.Words([" ".join(WORDS[:7]).encode()]).hashes)
    m["word"][1:] = rng.normal(size=m["word"][1:].shape)
    m["c"][:] = -0.3
    return m


def windows(words):
    starts = range(0, max(1, -(-(len(words) - T.WINDOW) // T.STRIDE) * T.STRIDE + 1), T.STRIDE)
    return [words[a:a + T.WINDOW] for a in starts]


def test_every_window_against_a_plain_scorer(model):
    rng = random.Random(2)
    texts = [b"", b"!!", b"You IDIOT, you", *(" ".join(rng.choice(WORDS) for _ in range(k)).encode() for k in (31, 32, 33, 48, 49, 100, 200))]
    words = T.Words(texts)
    want = [plain_score(model, w) for t in texts for w in windows(split(t))]
    assert len(want) == len(words.text) and np.allclose(T.window_scores(model, words), want, atol=2e-5)
    best = [max(plain_score(model, w) for w in windows(split(t))) for t in texts]
    assert np.allclose(T.score_texts(model, texts), best, atol=2e-5)


def test_long_texts_in_segments_have_the_same_windows(model, monkeypatch):
    rng = random.Random(4)
    for limit in (60, 200, 1000):
        for k in (5, 100, 700):
            text = " . ".join(rng.choice(WORDS + ["w" * 90]) for _ in range(k)).encode()
            parts = list(T.overlapping(text, limit))
            whole = {tuple(w) for w in windows(split(text))}
            got = [tuple(w) for p in parts for w in windows(split(p))]
            assert whole <= set(got)
            assert all(len(w) == T.WINDOW or w in whole for w in got) or len(parts) > 1
            for w in set(got) - whole:  # the rest are ends of segments: shorter than a window, and inside one
                assert len(w) < T.WINDOW and any(w == x[:len(w)] or w == x[-len(w):] for x in whole)


def test_training_texts_are_bounded(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(T, "train", lambda texts, label: seen.append((texts, label.tolist())))
    rows = [(i, "word " * (40 if i % 2 else 10)) for i in range(60) for _ in range(3)] + [(1, "another text of an id")] * 50 + [(2, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, toxic int")
    T.fit(spark, docs, labels)
    texts, label = seen.pop()
    assert label == sorted(label) and len(texts) == len([i for i in range(60) if not held(i)])  # one row an id
    monkeypatch.setattr(T, "TRAIN_BYTES", 1000)
    T.fit(spark, docs, labels, 20)
    texts, label = seen.pop()
    for value in (0, 1):
        size = [len(t) for t, x in zip(texts, label) if x == value]
        assert 0 < sum(size) <= 1000 and len(size) <= 20
    monkeypatch.setattr(T, "TRAIN_BYTES", 1)  # the first text is always taken
    T.fit(spark, docs, labels)
    assert seen.pop()[1].count(1) == 1


def held(i):
    import zlib
    return zlib.crc32(str(i).encode()) % 4 == 2
