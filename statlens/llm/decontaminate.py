"""Benchmark decontamination: size-partitioned MinHash containment search.

Documents and items are partitioned by the size of their shingle sets (powers of
two).  For a partition of items, a document of a partition with upper bound u has
a one-permutation MinHash sketch of ``c * u`` bins: hashes are dealt to bins by
their leading bits and each bin keeps its smallest hash.  The bins grow with the
document's partition, so an item's shingles survive in a long document's sketch as
often as in a short one's: a shared shingle is the minimum of its bin with a
chance of at least (1 - exp(-1/c)) * c.

An item is a candidate when the sketch holds at least half of the shingles that a
containment of ``threshold`` asks for.  ``c`` is the smallest power of two at which
an item of the partition that is contained is missed with a probability of at most
``MISS``: fewer shingles need more bins, as fewer of them may be lost (``bins``).
Candidates are verified by the exact containment of their shingles, compared word
by word.  Long texts are hashed and verified in segments.

The items are the stated queries: they go to the tasks in blocks of bounded
size, and each block's search scans the documents once, without a shuffle.
"""

from __future__ import annotations

import math
from typing import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statlens.llm.common import bounded_batches, drop_rows, row_key, staged, text_key
from statlens.llm.textvec import U64, WORD_TABLE, text_shingles, word_runs

WORDS, THRESHOLD, MISS = 5, 0.8, 1e-9
#: Bytes of item text in a block, bits of the hashes that a first look at the items takes.
ITEM_BLOCK, LOOK = 16 << 20, 18
MATCHES = "given boolean, d long, t1 long, t2 long, item_id long, shared long, item_shingles long, containment double"

def shingle_set(text: bytes, size: int = WORDS) -> set[tuple[bytes, ...]]:
    """The text's distinct runs of ``size`` words; A-Z lower-cased, punctuation aside."""
    w = text.translate(WORD_TABLE).split()
    return set(zip(*(w[i:] for i in range(size))))


def held_shingles(text: bytes, wanted: set[tuple[bytes, ...]], size: int = WORDS) -> set[tuple[bytes, ...]]:
    """Those of the ``wanted`` shingles that are in the text."""
    out, tail = set(), []
    for w in word_runs(text):
        w = tail + w
        out |= wanted.intersection(zip(*(w[i:] for i in range(size))))
        tail = w[max(0, len(w) - size + 1):]
    return out


def least_hits(count: int, threshold: float) -> int:
    """The shingles of an item that a sketch must hold to make it a candidate."""
    return max(1, math.ceil(count * threshold / 2 - 1e-9))


def bins(low: int, threshold: float = THRESHOLD) -> int:
    """log2 of the bins a shingle for items of ``low`` to ``2 * low - 1`` shingles; shingles taken as independent."""
    for c in range(2, 48):
        lost = 2.0 ** -(c + 1)  # at least 1 - (1 - exp(-x)) / x for x = 2 ** -c
        worst = 0.0
        for n in range(low, min(2 * low, low + 64)):
            shared = max(1, math.ceil(n * threshold - 1e-9))
            worst = max(worst, sum(math.comb(shared, k) * (1 - lost) ** k * lost ** (shared - k) for k in range(least_hits(n, threshold))))
        if worst <= MISS:
            return c
    return 48


class Items:
    """A block of items: their shingle sets, and the item by shingle hash for every partition."""

    def __init__(self, ids: list[int], texts: list[bytes], size: int, threshold: float):
        self.size, self.threshold = size, threshold
        sets = [shingle_set(t, size) for t in texts]
        at = [i for i, s in enumerate(sets) if s]
        self.ids, self.sets = [ids[i] for i in at], [sets[i] for i in at]
        h, k = [np.zeros(0, U64)], [np.zeros(0, np.int64)]
        for part, hashes, number in text_shingles([texts[i] for i in at], size):
            h.append(hashes)
            k.append(number + part.start)
        pairs = np.unique(np.stack([np.concatenate(h), np.concatenate(k).astype(U64)]), axis=1)
        hashes, item = pairs[0], pairs[1].astype(np.int64)
        count = np.bincount(item, minlength=len(at))
        self.least = np.array([least_hits(n, threshold) for n in count.tolist()], np.int64)
        self.maybe = np.zeros(1 << LOOK, bool)
        self.maybe[hashes >> U64(64 - LOOK)] = True
        part = np.frexp(count)[1] - 1  # of an item: log2 of its shingles, rounded down
        self.tables = []
        for p in np.unique(part).tolist():
            own = part[item] == p
            self.tables.append((bins(1 << p, threshold), hashes[own], item[own]))

    def candidates(self, hashes: np.ndarray, text: np.ndarray, n_texts: int) -> tuple[np.ndarray, np.ndarray]:
        """(text, item) of every item that the texts' sketches may hold."""
        order = np.lexsort((hashes, text))
        hashes, text = hashes[order], text[order]
        same = np.zeros(len(hashes), bool)  # text as before
        same[1:] = text[1:] == text[:-1]
        new = ~same
        new[1:] |= hashes[1:] != hashes[:-1]
        hashes, text, same = hashes[new], text[new], same[new]
        bits = np.ceil(np.log2(np.maximum(np.bincount(text, minlength=n_texts), 1))).astype(np.int64)[text]
        seen = np.flatnonzero(self.maybe[hashes >> U64(64 - LOOK)])  # no other hash is an item's
        before = seen - 1
        parts = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
        for c, known, item in self.tables:
            shift = np.maximum(64 - c - bits[seen], 0).astype(U64)
            # a text's hashes are sorted, so the first of a bin is its minimum
            low = ~same[seen] | (hashes[seen] >> shift != hashes[before] >> shift)
            parts.append(self.hits(known, item, hashes[seen[low]], text[seen[low]]))
        t, i = (np.concatenate(x) for x in zip(*parts))
        order = np.lexsort((i, t))
        return t[order], i[order]

    def hits(self, known: np.ndarray, item: np.ndarray, hashes: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(text, item) of the items of a partition (hash, item) that have enough of their shingles among the texts' minima."""
        a, b = np.searchsorted(known, hashes), np.searchsorted(known, hashes, side="right")
        found = np.flatnonzero(b > a)
        n = (b - a)[found]
        step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        pair = np.repeat(text[found], n) * len(self.ids) + item[np.repeat(a[found], n) + step]
        pair, hits = np.unique(pair, return_counts=True)
        t, i = np.divmod(pair, max(len(self.ids), 1))
        enough = hits >= self.least[i]
        return t[enough], i[enough]

    def search(self, ids: list[int], texts: list[bytes]) -> Iterator[tuple]:
        for part, h, t in text_shingles(texts, self.size):
            found: dict[int, list[int]] = {}
            for k, i in zip(*(x.tolist() for x in self.candidates(h, t, part.stop - part.start))):
                found.setdefault(k, []).append(i)
            for k, items in found.items():
                held = held_shingles(texts[part][k], set().union(*(self.sets[i] for i in items)), self.size)
                for i in items:
                    shared, all_ = len(self.sets[i] & held), len(self.sets[i])
                    if shared >= math.ceil(self.threshold * all_ - 1e-9):
                        yield ids[part][k], self.ids[i], shared, all_, shared / all_


def matches(spark: SparkSession, docs: DataFrame, items: DataFrame, size: int = WORDS,
            threshold: float = THRESHOLD, block: int = ITEM_BLOCK) -> DataFrame:
    """The ``row_key`` of every row that contains an item, with ``item_id, shared, item_shingles, containment``."""
    bounded_batches(spark)
    docs = docs.select(*row_key(), F.col("text").cast("string").alias("t")).where("length(t) > 0")
    items = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("t")).where(
        "item_id IS NOT NULL AND length(t) > 0").distinct()
    volume = items.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    blocks = max(1, math.ceil(volume / block))
    out = None
    for k in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == k).collect()
        stated = spark.sparkContext.broadcast(([r[0] for r in rows], [r[1].encode("utf-8", "surrogatepass") for r in rows]))

        def run(batches: Iterator[pd.DataFrame], stated=stated) -> Iterator[pd.DataFrame]:
            block = Items(*stated.value, size, threshold)
            for b in batches:
                found = list(block.search(list(range(len(b))), [t.encode("utf-8", "surrogatepass") for t in b["t"]]))
                found = pd.DataFrame(found, columns=["row", "item_id", "shared", "item_shingles", "containment"])
                key = b[["given", "d", "t1", "t2"]].iloc[found["row"].tolist()].reset_index(drop=True)
                yield pd.concat([key, found.drop(columns="row")], axis=1)

        part = docs.mapInPandas(run, MATCHES)
        out = part if out is None else out.union(part)
    return out


def contained_items(spark: SparkSession, docs: DataFrame, items: DataFrame, size: int = WORDS,
                    threshold: float = THRESHOLD, block: int = ITEM_BLOCK) -> DataFrame:
    """``doc_id, item_id, shared, item_shingles, containment``: a row per document and item that it contains.

    An item is contained when at least ``threshold`` of its distinct shingles
    are in the document.  Items with fewer than ``size`` words (empty and null
    ones too) have no shingle and are contained nowhere; a null or empty document
    contains nothing; documents without an id give rows with a null; items
    without an id take no part.  Equal rows are given once.  Empty tables give
    an empty result; other columns are not read.
    """
    found = matches(spark, docs, items, size, threshold, block)
    return found.selectExpr("if(given, d, NULL) AS doc_id", "item_id", "shared", "item_shingles", "containment").distinct()


def drop_contaminated(spark: SparkSession, docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs`` that contain no item, with all their columns; rows without an id are searched like others."""
    gone = staged(spark, matches(spark, docs, items).selectExpr("if(given, d, NULL) AS doc_id", "t1", "t2").distinct(), "leaks")
    return drop_rows(docs, gone, text_key())
