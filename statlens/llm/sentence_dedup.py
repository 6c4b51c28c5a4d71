"""Substring dedup by sliding sentence spans.

For every sentence, the shortest runs of at least ``SENTENCES`` consecutive
sentences with at least ``WORDS`` words that begin and that end with it are
spans; a span is hashed over its words (A-Z lower-cased, punctuation aside).
Spans are joined globally by their 128-bit hash, and sentences covered by a span
that is not the first of its kind (smallest id, then place) are removed.  Any
run that meets the minimum is covered by the spans inside it, so every repeated
run goes to its last sentence.  A minimum of words keeps chance repeats of a few
short sentences from counting.

Sentences of more than ``LONG`` words are cut where their words say so (see
``cuts``), so a passage inside longer text without stops is cut alike wherever
it stands.

The first pass counts span hashes (partial aggregation before the shuffle) and
builds a sieve; only spans that may repeat are then written with their places.
"""

from __future__ import annotations

import hashlib
import re
from itertools import accumulate
from typing import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statlens.llm.common import staged
from statlens.llm.textvec import WORD_TABLE as _TABLE
from statlens.llm.sieve import passes, sieve
from statlens.llm.suffix_dedup import hashes64, hashes128, keyed, merged, parts, with_text

SENTENCES, WORDS, LONG, CUT, NEAR = 2, 12, 40, 20, 3
_SENTENCE = re.compile(rb"[^.!?\n]*(?:[.!?\n]+\s*|$)")
_WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+[^0-9A-Za-z\x80-\xff]*")


def cuts(words: list[bytes]) -> list[int]:
    """Places where a long sentence is cut: after the word whose hash is the smallest of the ``NEAR`` words on each side.

    Such a cut depends on these words alone.  Between cuts that are more than
    ``LONG`` words apart (a few words said over and over) the text is cut after
    the smallest of the last ``NEAR`` + 1 of each ``CUT`` words.
    """
    h = hashes64(words)
    n = len(h) - 2 * NEAR
    low = np.ones(max(n, 0), bool)
    for k in range(1, NEAR + 1):
        low &= (h[NEAR:NEAR + n] < h[NEAR - k:NEAR - k + n]) & (h[NEAR:NEAR + n] <= h[NEAR + k:NEAR + k + n])
    out, at = [], 0
    for end in [*(np.flatnonzero(low) + NEAR + 1).tolist(), len(words)]:
        while end - at > LONG:
            at += CUT - NEAR + int(np.argmin(h[at + CUT - NEAR - 1:at + CUT]))
            out.append(at)
        out.append(end)
        at = end
    return out


def sentences(text: bytes) -> tuple[list[int], list[list[bytes]]]:
    """(ends, words) of the text's sentences; they cover it, and wordless ones belong to their neighbour."""
    ends, words = [], []

    def add(end: int, w: list[bytes]) -> None:
        if (w and words and words[-1]) or not words:
            ends.append(end)
            words.append(w)
        else:  # a wordless sentence goes to the one before, or to the next at the text's start
            ends[-1] = end
            words[-1] = words[-1] or w

    for m in _SENTENCE.finditer(text):
        if m.end() == m.start():
            continue
        w = m[0].translate(_TABLE).split()
        if len(w) <= LONG:
            add(m.end(), w)
            continue
        after, at = [m.start() + x.end() for x in _WORD.finditer(m[0])], 0
        for end in cuts(w):
            add(after[end - 1], w[at:end])
            at = end
    return ends, words


def spans(words: list[list[bytes]], least: int = SENTENCES, least_words: int = WORDS) -> Iterator[tuple[int, int, bytes]]:
    """(first, last + 1, words) of the shortest spans that begin and that end with each sentence, in order, each once."""
    total, n = [0, *accumulate(map(len, words))], len(words)
    joined, found, j = [b" ".join(w) for w in words], [], 0
    for i in range(n):  # the shortest from i on
        while j < n and (j - i < least or total[j] - total[i] < least_words):
            j += 1
        if j - i < least or total[j] - total[i] < least_words:
            break
        found.append((i, j))
    i = 0
    for j in range(least, n + 1):  # the shortest up to j
        while j - i > least and total[j] - total[i + 1] >= least_words:
            i += 1
        if total[j] - total[i] >= least_words:
            found.append((i, j))
    for i, j in sorted(set(found)):
        yield i, j, b"\n".join(joined[i:j])


def repeated_sentences(spark: SparkSession, docs: DataFrame, least: int = SENTENCES, least_words: int = WORDS) -> DataFrame:
    """``d, t1, spans``: ranges of sentences to remove, of the texts that have any."""
    rows = keyed(docs)

    def first_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in parts(batches):
            yield pa.RecordBatch.from_pydict({"h": hashes64(s for t in texts for _, _, s in spans(sentences(t)[1], least, least_words))})

    counts = rows.select("text").mapInArrow(first_pass, "h long").groupBy("h").count().where("count > 1").select("h")
    shared = spark.sparkContext.broadcast(sieve(staged(spark, counts, "sentences"), "h"))

    def second_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = shared.value
        for b, texts in parts(batches):
            rows = []
            for d, t1, t in zip(b.column("d").to_pylist(), b.column("t1").to_pylist(), texts):
                own = list(spans(sentences(t)[1], least, least_words))
                at = np.flatnonzero(passes(words, hashes64(s for _, _, s in own)))
                if len(at):
                    rows += [(d, t1, own[k][0], own[k][1], *h) for k, h in zip(at, hashes128(own[k][2] for k in at).tolist())]
            if rows:
                yield pa.RecordBatch.from_pydict(dict(zip(("d", "t1", "i", "j", "h1", "h2"), (pa.array(c, pa.int64()) for c in zip(*rows)))))

    found = staged(spark, rows.select("d", "t1", "text").mapInArrow(second_pass, "d long, t1 long, i long, j long, h1 long, h2 long"), "spans")
    first = found.groupBy("h1", "h2").agg(F.min(F.struct("d", "t1", "i")).alias("f"), F.count(F.lit(1)).alias("n")).where("n > 1")
    first = staged(spark, first.selectExpr("h1 AS g1", "h2 AS g2", "f.d AS fd", "f.t1 AS ft", "f.i AS fi"), "firsts")
    later = found.join(first, F.expr("h1 = g1 AND h2 = g2")).where("NOT (d = fd AND t1 = ft AND i = fi)")
    return staged(spark, later.groupBy("d", "t1").agg(F.collect_set(F.struct("i", "j")).alias("spans")), "later")


def dedup_sentences(spark: SparkSession, docs: DataFrame, least: int = SENTENCES, least_words: int = WORDS) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_bytes, n_removed, n_spans, kept_sha256, text``.

    ``text`` is what is left, ``n_removed`` the bytes (UTF-8) and ``n_spans`` the
    maximal runs of sentences that are gone.  The first of equal spans stays, in
    the order of ids (a null comes first) and places; repeats within a document
    go too.  Rows that repeat an id with an equal text are one document, returned
    as often as it comes; with another text they are ordered by its hash.  Null
    counts as empty; a text of few words stays.  An empty table gives an empty
    result; other columns are not read.
    """
    rows = with_text(spark, docs, repeated_sentences(spark, docs, least, least_words), all_texts=True)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for text, cut, sha in zip(b["text"], b["spans"], b["sha256"]):
                if cut is None:
                    out.append((0, 0, sha, text))
                    continue
                t = text.encode("utf-8", "surrogatepass")
                ends = [0, *sentences(t)[0]]
                gone = [(ends[i], ends[j]) for i, j in merged((int(x["i"]), int(x["j"])) for x in cut)]
                at, left = 0, []
                for s, e in gone:
                    left.append(t[at:s])
                    at = e
                left = b"".join([*left, t[at:]])
                out.append((len(t) - len(left), len(gone), hashlib.sha256(left).hexdigest(), left.decode("utf-8", "surrogatepass")))
            got = pd.DataFrame(out, columns=["n_removed", "n_spans", "kept_sha256", "text"], index=b.index)
            yield pd.concat([b["doc_id"].astype("Int64"), b["n_bytes"], got], axis=1)

    return rows.select("doc_id", "n_bytes", "sha256", "text", "spans").mapInPandas(
        run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, text string")
