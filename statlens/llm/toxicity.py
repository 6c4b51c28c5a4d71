"""Toxicity: a bidirectional gated recurrent network with attention pooling, in numpy.

A word's input is its word embedding (zero for words in fewer than ``LEAST_DOCS``
training documents) beside the mean embedding of its character trigrams.
Windows of ``WINDOW`` words, ``STRIDE`` apart, cover a whole text; a forward and a backward GRU run over each window, attention pools their
states, and a logistic unit scores the pool.  A document's score is that of its
highest window.

The network is trained on at most ``SAMPLE`` labelled documents of each class
(those with the smallest hashes of their ids; one row an id, the smallest text),
and on no more than ``TRAIN_BYTES`` of text of each class: whole texts in the
order of those hashes, and the first is taken whatever its size.  A document's label
is known, not that of its windows: first the windows with the largest sum of
word log odds stand for their documents, then those that the network itself
scores highest.  Word log odds also start the first dimension of the word
embedding.  Scoring is one pass over the documents, without a shuffle; a text of
more than ``TEXT_BLOCK`` bytes is scored in segments that overlap by a window, so
every window that starts at a multiple of ``STRIDE`` words is scored.
"""

from __future__ import annotations

from typing import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from statlens.llm.common import bounded_batches
from statlens.llm.textvec import BASE, FOLD, INVERSE, IS_WORD, U64, mix, powers, segments, slices

SAMPLE, LEAST_DOCS, THRESHOLD, TRAIN_BYTES = 1000, 3, 0.3, 8 << 20
WINDOW, STRIDE, HIDDEN, WORD_DIM, CHAR_DIM, ATTENTION = 32, 16, 8, 8, 8, 8
CHAR_BUCKETS = 1 << 12
PHASES, STEPS, BATCH, RATE, TEXT_BLOCK, WINDOW_BLOCK = 3, 120, 128, 0.01, 1 << 19, 4096


class Words:
    """The words of some texts: distinct words with their buckets, and every text's windows of them."""

    def __init__(self, texts: list[bytes]):
        joined = FOLD[np.frombuffer(b" " + b" ".join(texts) + b"  ", np.uint8)]
        inside = np.r_[False, IS_WORD[joined]]
        turns = np.flatnonzero(inside[1:] != inside[:-1])
        start, end = turns[::2], turns[1::2]
        sums = np.zeros(len(joined) + 1, U64)
        np.cumsum(mix(np.arange(1, 257, dtype=U64))[joined] * powers(BASE, len(joined)), out=sums[1:])
        hashes = mix((sums[end] - sums[start]) * powers(INVERSE, len(joined))[start] + (end - start).astype(U64))
        self.hashes, lead, self.word = np.unique(hashes, return_index=True, return_inverse=True)
        n = (end - start)[lead]  # a trigram around each byte of the word
        at = np.repeat(start[lead], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        x = np.where(IS_WORD[joined], joined, 32).astype(np.uint32)  # what stands beside a word is no part of it
        code = x[at - 1] * np.uint32(0x9E3779B1) ^ x[at] * np.uint32(0x85EBCA6B) ^ x[at + 1] * np.uint32(0xC2B2AE35)
        self.gram = ((code * np.uint32(0x27D4EB2F)) >> np.uint32(20)).astype(np.int64) & (CHAR_BUCKETS - 1)
        self.gram_start, self.gram_count = np.cumsum(n) - n, n
        ends = np.cumsum([1 + len(t) for t in texts])
        self.first = np.searchsorted(start, np.r_[0, ends])  # each text's first word
        count = np.diff(self.first)
        windows = np.maximum(1, -(-(count - WINDOW) // STRIDE) + 1)
        self.text = np.repeat(np.arange(len(texts)), windows)
        step = np.arange(len(self.text)) - np.repeat(np.cumsum(windows) - windows, windows)
        self.start = self.first[:-1][self.text] + step * STRIDE
        self.size = np.clip(self.first[1:][self.text] - self.start, 0, WINDOW)

    def ids(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(distinct word, mask) of the places of the windows ``which``."""
        place = self.start[which][:, None] + np.arange(WINDOW)
        mask = np.arange(WINDOW) < self.size[which][:, None]
        word = self.word if len(self.word) else np.zeros(1, np.int64)
        return word[np.minimum(place, len(word) - 1)] * mask, mask

    def known(self, model: dict, which: np.ndarray | slice = slice(None)) -> np.ndarray:
        """The row of each distinct word in the word embedding; 0, which stays zero, for unknown words."""
        h, vocab = self.hashes[which], model["vocab"]
        if not len(vocab):
            return np.zeros(len(h), np.int64)
        at = np.minimum(np.searchsorted(vocab, h), len(vocab) - 1)
        return np.where(vocab[at] == h, at + 1, 0)

    def inputs(self, model: dict, which: np.ndarray | slice = slice(None)) -> np.ndarray:
        """The input vectors of the distinct words ``which``."""
        known = self.known(model, which)
        if not len(known):
            return np.zeros((1, WORD_DIM + CHAR_DIM), np.float32)
        n, s = self.gram_count[which], self.gram_start[which]
        off = np.cumsum(n) - n
        at = np.repeat(s - off, n) + np.arange(n.sum())
        chars = np.add.reduceat(model["char"][self.gram[at]], off, axis=0) / n[:, None]
        return np.concatenate([model["word"][known], chars], axis=1).astype(np.float32)


def sigmoid(x):
    return np.float32(0.5) * np.tanh(np.float32(0.5) * x) + np.float32(0.5)


def new_model(vocab: np.ndarray, seed: int = 7) -> dict[str, np.ndarray]:
    rng, d = np.random.default_rng(seed), WORD_DIM + CHAR_DIM
    make = lambda *shape, scale: (rng.standard_normal(shape) * scale).astype(np.float32)
    model = {"vocab": vocab, "word": np.zeros((len(vocab) + 1, WORD_DIM), np.float32), "char": make(CHAR_BUCKETS, CHAR_DIM, scale=0.1)}
    for k in "fb":
        model |= {"W" + k: make(d, 3 * HIDDEN, scale=0.3), "U" + k: make(HIDDEN, 3 * HIDDEN, scale=0.3),
                  "b" + k: np.zeros(3 * HIDDEN, np.float32)}
    return model | {"A": make(2 * HIDDEN, ATTENTION, scale=0.3), "a": make(ATTENTION, scale=0.3),
                    "u": make(2 * HIDDEN, scale=0.3), "c": np.zeros(1, np.float32)}


def forward(m: dict, gates: dict[str, np.ndarray], ids: np.ndarray, mask: np.ndarray, keep: dict | None = None) -> np.ndarray:
    """Logits of windows; ``gates`` has each direction's input terms by distinct word; ``keep`` gets what backward needs."""
    n, hid = len(ids), HIDDEN
    states = np.empty((n, WINDOW, 2 * hid), np.float32)
    on = mask.astype(np.float32)
    for k, order, part in (("f", range(WINDOW), slice(0, hid)), ("b", range(WINDOW - 1, -1, -1), slice(hid, 2 * hid))):
        h = np.zeros((n, hid), np.float32)
        for t in order:
            x, r_h = gates[k][ids[:, t]], h @ m["U" + k]
            zr = sigmoid(x[:, :2 * hid] + r_h[:, :2 * hid])
            z, r = zr[:, :hid], zr[:, hid:]
            new = np.tanh(x[:, 2 * hid:] + r * r_h[:, 2 * hid:])
            if keep is not None:
                keep[k, t] = h, z, r, new, r_h[:, 2 * hid:]
            h = h + on[:, t, None] * (1 - z) * (new - h)
            states[:, t, part] = h
    e = np.tanh(states @ m["A"])
    weight = np.exp(e @ m["a"]) * on
    total = weight.sum(axis=1, keepdims=True)
    weight /= np.where(total > 0, total, 1)
    pool = (weight[:, :, None] * states).sum(axis=1)
    if keep is not None:
        keep |= {"states": states, "e": e, "weight": weight, "pool": pool}
    return pool @ m["u"] + m["c"]


def gradients(m: dict, words: Words, which: np.ndarray, label: np.ndarray) -> dict[str, np.ndarray]:
    """Gradients of the mean logistic loss over the windows ``which``."""
    ids, mask = words.ids(which)
    own, ids = np.unique(ids, return_inverse=True)
    ids = ids.reshape(mask.shape)
    x = words.inputs(m, own)
    keep: dict = {}
    logit = forward(m, {k: x @ m["W" + k] + m["b" + k] for k in "fb"}, ids, mask, keep)
    n, hid, on = len(ids), HIDDEN, mask.astype(np.float32)
    d_logit = ((sigmoid(logit) - label) / n).astype(np.float32)
    states, e, weight, pool = keep["states"], keep["e"], keep["weight"], keep["pool"]
    g = {"u": pool.T @ d_logit, "c": d_logit.sum(keepdims=True)}
    d_pool = d_logit[:, None] * m["u"]
    d_weight = (states * d_pool[:, None, :]).sum(axis=2)
    d_score = weight * (d_weight - (weight * d_weight).sum(axis=1, keepdims=True))
    d_e = d_score[:, :, None] * m["a"] * (1 - e * e)
    g["a"] = (d_score[:, :, None] * e).sum(axis=(0, 1))
    g["A"] = np.einsum("nti,nta->ia", states, d_e)
    d_states = weight[:, :, None] * d_pool[:, None, :] + d_e @ m["A"].T
    d_x = np.zeros_like(x)
    for k, order, part in (("f", range(WINDOW - 1, -1, -1), slice(0, hid)), ("b", range(WINDOW), slice(hid, 2 * hid))):
        d_h, d_gate, d_u = np.zeros((n, hid), np.float32), np.zeros((len(x), 3 * hid), np.float32), np.zeros_like(m["U" + k])
        for t in order:
            h, z, r, new, rec = keep[k, t]
            d_h = d_h + d_states[:, t, part]
            s = on[:, t, None]
            d_new = d_h * s * (1 - z) * (1 - new * new)
            d_z = -d_h * s * (new - h) * z * (1 - z)
            d_r = d_new * rec * r * (1 - r)
            d_in = np.concatenate([d_z, d_r, d_new], axis=1)
            d_rec = np.concatenate([d_z, d_r, d_new * r], axis=1)
            d_u += h.T @ d_rec
            np.add.at(d_gate, ids[:, t], d_in)
            d_h = d_h * (1 - s * (1 - z)) + d_rec @ m["U" + k].T
        g |= {"U" + k: d_u, "W" + k: x.T @ d_gate, "b" + k: d_gate.sum(axis=0)}
        d_x += d_gate @ m["W" + k].T
    g["word"], g["char"] = np.zeros_like(m["word"]), np.zeros_like(m["char"])
    if len(words.hashes):
        np.add.at(g["word"], words.known(m, own), d_x[:, :WORD_DIM])
        g["word"][0] = 0
        count, start = words.gram_count[own], words.gram_start[own]
        at = np.repeat(start - (np.cumsum(count) - count), count) + np.arange(count.sum())
        np.add.at(g["char"], words.gram[at], np.repeat(d_x[:, WORD_DIM:] / count[:, None], count, axis=0))
    return g


def window_scores(m: dict, words: Words) -> np.ndarray:
    """The score of every window."""
    x = words.inputs(m)
    gates = {k: x @ m["W" + k] + m["b" + k] for k in "fb"}
    out = np.empty(len(words.text), np.float32)
    for i in range(0, len(out), WINDOW_BLOCK):
        which = np.arange(i, min(i + WINDOW_BLOCK, len(out)))
        out[which] = forward(m, gates, *words.ids(which))
    return sigmoid(out)


def highest(words: Words, score: np.ndarray) -> np.ndarray:
    """Each text's window with the highest score (the first of equals)."""
    order = np.lexsort((np.arange(len(score)), -score, words.text))
    return order[np.unique(words.text[order], return_index=True)[1]]


def train(texts: list[bytes], label: np.ndarray, seed: int = 7) -> dict[str, np.ndarray]:
    """The network for whole texts with labels 0 and 1 (both occur)."""
    words, rng = Words(texts), np.random.default_rng(seed)
    doc = np.repeat(np.arange(len(texts)), np.diff(words.first))
    pairs = np.unique(doc * len(words.hashes) + words.word) if len(words.word) else np.zeros(0, np.int64)
    d, w = np.divmod(pairs, max(1, len(words.hashes)))
    bad, all_ = np.bincount(w, label[d], len(words.hashes)), np.bincount(w, minlength=len(words.hashes))
    pos, neg = label.sum(), (1 - label).sum()
    odds = np.log((bad + 0.5) / (pos + 1)) - np.log((all_ - bad + 0.5) / (neg + 1))
    odds *= all_ / (all_ + 5)
    often = np.flatnonzero(all_ >= LEAST_DOCS)
    m = new_model(words.hashes[often], seed)
    m["word"][1:, 0] = np.clip(odds[often], -3, 3)
    odds[all_ < LEAST_DOCS] = 0
    total = np.r_[0, np.cumsum(odds[words.word])] if len(words.word) else np.zeros(1)
    score = total[words.start + words.size] - total[words.start]
    moment = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in m.items() if k != "vocab"}
    step = 0
    windows = label[words.text]
    for _ in range(PHASES):
        top = highest(words, score)
        bad_ones = top[windows[top] == 1]
        good_ones = np.r_[top[windows[top] == 0], rng.permutation(np.flatnonzero(windows == 0))[:len(texts)]]
        for _ in range(STEPS):  # half of a batch are windows of toxic documents
            step += 1
            part = np.r_[rng.choice(bad_ones, BATCH // 2), rng.choice(good_ones, BATCH // 2)]
            for k, v in gradients(m, words, part, windows[part].astype(np.float32)).items():
                one, two = moment[k]
                one += 0.1 * (v - one)
                two += 0.01 * (v * v - two)
                m[k] -= RATE * (one / (1 - 0.9 ** step)) / (np.sqrt(two / (1 - 0.99 ** step)) + 1e-6)
        score = window_scores(m, words)
    return m


def overlapping(text: bytes, limit: int = TEXT_BLOCK) -> Iterator[bytes]:
    """A text in segments of about ``limit`` bytes; each begins at a multiple of ``STRIDE`` words and holds all windows that start in its part."""
    if len(text) <= limit:
        yield text
        return
    starts, at, word = [], 0, 0
    for a, e in segments(text, limit // 4):  # where every STRIDE-th word starts
        inside = np.r_[False, IS_WORD[np.frombuffer(text, np.uint8, e - a, a)]]
        first = np.flatnonzero(inside[1:] & ~inside[:-1])
        starts.append(a + first[(-word) % STRIDE::STRIDE])
        word += len(first)
    starts = np.concatenate(starts)
    ahead, k = WINDOW // STRIDE + 1, 0
    while True:
        end = max(int(np.searchsorted(starts, at + limit)), k + 1)
        yield text[at:int(starts[end + ahead]) if end + ahead < len(starts) else len(text)]
        if end + ahead >= len(starts):
            return
        at, k = int(starts[end]), end


def score_texts(m: dict, texts: list[bytes]) -> np.ndarray:
    """The highest window's score of each text; a text without a word has one empty window."""
    out = np.zeros(len(texts))
    pieces = [(i, p) for i, t in enumerate(texts) for p in overlapping(t)]
    for part in slices([len(p) for _, p in pieces], TEXT_BLOCK):
        words, number = Words([p for _, p in pieces[part]]), np.array([i for i, _ in pieces[part]])
        np.maximum.at(out, number[words.text], window_scores(m, words).astype(float))
    return out


def fit(spark: SparkSession, docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> dict[str, np.ndarray] | None:
    """The network from ``labels`` (``doc_id, toxic``) of documents that are not held out; None if a class is missing."""
    known = labels.select(F.col("doc_id").cast("long").alias("l_"), "toxic").where("toxic IN (0, 1) AND l_ IS NOT NULL")
    known = known.where(f"NOT ({HELD_OUT.format('l_')})").groupBy("l_").agg(F.max("toxic").alias("toxic"))
    rows = []
    for value in (0, 1):
        ids = known.where(F.col("toxic") == value).select("l_", F.xxhash64("l_").alias("h")).orderBy("h", "l_").limit(sample)
        found = docs.join(F.broadcast(ids), F.col("doc_id").cast("long") == F.col("l_"))  # at most ``sample`` ids
        texts = found.groupBy("h", "l_").agg(F.min(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("t"))
        upto = F.sum(F.octet_length("t")).over(Window.orderBy("h", "l_"))  # at most ``sample`` rows
        rows.append(texts.withColumn("upto", upto).where(f"upto <= {TRAIN_BYTES} OR upto = octet_length(t)").select("l_", "t").toPandas().sort_values("l_", kind="stable"))
    if rows[0].empty or rows[1].empty:
        return None
    texts = [t.encode("utf-8", "surrogatepass") for r in rows for t in r["t"]]
    return train(texts, np.r_[np.zeros(len(rows[0]), np.int64), np.ones(len(rows[1]), np.int64)])


#: SQL of whether a document is kept from training.
HELD_OUT = "coalesce(crc32(cast(cast({} AS string) AS binary)) % 4 = 2, false)"


def score_documents(spark: SparkSession, docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD,
                    sample: int = SAMPLE) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row of ``docs``.

    Null and empty texts are scored as one empty window.  A null id is not held
    out; rows that repeat an id are scored one by one; of labels that repeat an id
    the larger counts.  Where no label of one of the classes can be learnt, all
    scores are 0.  An empty table gives an empty result; other columns are not
    inputs.
    """
    bounded_batches(spark)
    model = spark.sparkContext.broadcast(fit(spark, docs, labels, sample))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = model.value
        for b in batches:
            score = np.zeros(len(b)) if m is None else score_texts(m, [t.encode("utf-8", "surrogatepass") for t in b["t"]])
            yield pd.DataFrame({"doc_id": b["doc_id"], "held_out": b["held_out"], "score": score, "predicted": (score >= threshold).astype(np.int32)})

    rows = docs.selectExpr("cast(cast(doc_id AS long) AS string) AS doc_id", f"{HELD_OUT.format('cast(doc_id AS long)')} AS held_out",
                           "coalesce(cast(text AS string), '') AS t")
    return rows.mapInPandas(run, "doc_id string, held_out boolean, score double, predicted int").withColumn("doc_id", F.col("doc_id").cast("long"))
