"""Spelling variant grouping with a bidirectional FM-index.

Words are counted by partial sums in each task.  Two words are near if one
insertion, deletion or replacement of a code point turns one into the other.  The
error lies in one half of a word, so the other half is matched exactly:
* its first half, then rightwards across the second, allowing one error;
* its second half, then leftwards across the first, allowing one error.

Words meet by these halves: a word is indexed under the prefixes and suffixes
that can be a half of a word whose length differs by at most one, and searches
under its own two halves.  Halves are dealt to shards of about ``SHARD`` rows; a
half with more is split by the indexed words, and its searches go to every part.

A shard's text is its words between delimiters.  A suffix array of the text and
one of its reverse give ranks; a search keeps an interval of ranks in both, so it
extends a match on either side by any symbol (counts of the symbols up to each
one, in blocks of 64 ranks, give an extension from four look-ups).  All searches
of a part of the shard go on together, one symbol a step.
"""

from __future__ import annotations

import re
from collections import Counter
from typing import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statlens.llm.common import LOWER, UPPER, bounded_batches, staged

LEAST_LENGTH, LEAST_COUNT, RATIO, DELETE = 6, 5, 5, 199
#: Rows of a shard, words that search together, characters of text taken at once, words that a task counts before it hands them on.
SHARD, TOGETHER, TEXT_BLOCK, COUNTED = 50_000, 4096, 1 << 18, 200_000
#: A word's count at least grows by ``RATIO`` from form to form, so a chain of forms has fewer than 28 steps; each round doubles those taken.
ROUNDS = 5

RUN, END = re.compile("[a-zÀ-ÿ]+"), re.compile("[^a-zÀ-ÿ]")
FOLD = str.maketrans(UPPER, LOWER)


def run_counts(text: str) -> Counter:
    """How often each run of letters is in the whole text, A-Z lower-cased."""
    out: Counter = Counter()
    at, text = 0, text.translate(FOLD)
    while at < len(text):
        cut = END.search(text, min(at + TEXT_BLOCK, len(text)))  # a run is never cut
        end = cut.start() if cut else len(text)
        out.update(RUN.findall(text, at, end))
        at = end
    return out


def word_counts(docs: DataFrame, least_length: int = LEAST_LENGTH, delete: int = DELETE) -> DataFrame:
    """``word, n``: the runs of all texts, some of them changed, with at least ``least_length`` code points.

    h is the CRC-32 of ``<doc_id>:<run>`` (a null id: empty); where ``delete``
    divides it, the run loses its code point at h modulo its length.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()

        def handed():
            out = pa.RecordBatch.from_arrays([pa.array(total, pa.string()), pa.array(total.values(), pa.int64())], names=["word", "n"])
            total.clear()
            return out

        for b in batches:
            for i, text in zip(b.column("id").to_pylist(), b.column("text")):
                counts = run_counts(text.as_py())
                start = crc32(f"{i}:".encode())
                for w, n in counts.items():
                    if len(w) >= least_length:
                        h = crc32(w.encode(), start)
                        if h % delete == 0:
                            k = h % len(w)
                            w = w[:k] + w[k + 1:]
                            if len(w) < least_length:
                                continue
                        total[w] += n
                if len(total) >= COUNTED:
                    yield handed()
        yield handed()

    rows = docs.select(F.coalesce(F.col("doc_id").cast("long").cast("string"), F.lit("")).alias("id"),
                       F.col("text").cast("string").alias("text")).where("length(text) > 0")
    return rows.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


class Direction:
    """Ranks of the suffixes of a text (codes from 1; 0 ends it) and counts of what precedes them."""

    def __init__(self, text: np.ndarray, symbols: int):
        text = np.append(text, 0)
        self.suffixes = suffix_array(text)
        self.before = text[self.suffixes - 1]  # of the first suffix: the end
        self.first = np.searchsorted(text[self.suffixes], np.arange(symbols + 1))  # rank of the first suffix with a symbol
        self.blocks = len(text) // 64 + 1
        bits, cum = np.zeros((symbols, self.blocks), np.uint64), np.zeros((symbols, self.blocks), np.int64)
        for c in range(symbols):  # the symbols up to c
            packed = np.packbits(self.before <= c, bitorder="little")
            bits[c].view(np.uint8)[:len(packed)] = packed
            cum[c, 1:] = np.cumsum(np.bitwise_count(bits[c, :-1]))
        self.bits, self.cum = bits.ravel(), cum.ravel()

    def up_to(self, c: np.ndarray, rank: np.ndarray) -> np.ndarray:
        """How many of the suffixes before ``rank`` follow a symbol of at most ``c`` (0 for c below 0)."""
        at = c * self.blocks + (rank >> 6)
        inside = self.bits.take(at, mode="wrap") & ((np.uint64(1) << (rank & 63).astype(np.uint64)) - np.uint64(1))
        return np.where(c < 0, 0, self.cum.take(at, mode="wrap") + np.bitwise_count(inside))


def suffix_array(text: np.ndarray) -> np.ndarray:
    """The starts of the suffixes in order, by doubling; the last symbol is the smallest and single."""
    rank, k, n = text.astype(np.int64), 1, len(text)
    while True:
        key = rank * (n + 1)
        key[:-k] += rank[k:] + 1
        order = np.argsort(key, kind="stable")
        step = np.zeros(n, np.int64)
        step[1:] = np.cumsum(key[order][1:] != key[order][:-1])
        rank = np.empty(n, np.int64)
        rank[order] = step
        if step[-1] == n - 1:
            return order
        k *= 2


class Index:
    """A bidirectional FM-index of distinct words (Latin-1 bytes, sorted) between delimiters.

    A state is (rank in the text's suffixes, rank in the reverse's, size): the
    interval of a string in one array and of its reverse in the other.
    """

    def __init__(self, words: list[bytes]):
        joined = np.frombuffer(b"\n" + b"\n".join(words) + b"\n", np.uint8)
        letters = np.unique(joined)  # the delimiter, 10, is below all letters: code 1
        self.code = np.zeros(256, np.int64)
        self.code[letters] = np.arange(1, len(letters) + 1)
        self.symbols = len(letters) + 1
        text = self.code[joined]
        self.left, self.right = Direction(text, self.symbols), Direction(text[::-1], self.symbols)
        starts = np.cumsum([0, *(len(w) + 1 for w in words)])
        self.word = np.searchsorted(starts, self.left.suffixes, side="right") - 1  # the word at or after a rank's delimiter
        self.n = len(text) + 1

    def extend(self, state: np.ndarray, c: np.ndarray, rightwards: bool) -> np.ndarray:
        """The states (a row each of rank, reverse rank, size) of the strings with ``c`` put before or after them."""
        own, other, size = state if not rightwards else (state[1], state[0], state[2])
        d = self.right if rightwards else self.left
        below = d.up_to(c - 1, own)
        width_below = d.up_to(c - 1, own + size) - below
        new = d.up_to(c, own)
        width = d.up_to(c, own + size) - new - width_below
        own, other = d.first[c] + new - below, other + width_below
        return np.stack([other, own, width] if rightwards else [own, other, width])

    def next_symbols(self, state: np.ndarray, rightwards: bool) -> tuple[np.ndarray, np.ndarray]:
        """(state's number, letter) of every letter that can follow; some that cannot, where many can."""
        d, own, size = (self.right, state[1], state[2]) if rightwards else (self.left, state[0], state[2])
        few = np.flatnonzero(size <= self.symbols)
        n = size[few]
        at = np.repeat(np.arange(len(few)), n)
        symbol = d.before[np.repeat(own[few] - np.cumsum(n) + n, n) + np.arange(n.sum())]
        pair = np.unique(at * self.symbols + symbol)
        at, symbol = np.divmod(pair, self.symbols)
        many = np.flatnonzero(size > self.symbols)
        number = np.concatenate([few[at], np.repeat(many, self.symbols - 2)])
        symbol = np.concatenate([symbol, np.tile(np.arange(2, self.symbols), len(many))])
        return number[symbol > 1], symbol[symbol > 1]

    def near(self, words: list[bytes], rightwards: bool) -> tuple[np.ndarray, np.ndarray]:
        """(number in ``words``, indexed word) of the words with one error in the half that is searched last.

        ``rightwards``: the first half matches, else the second.  A pair may come
        more than once.
        """
        length = np.array([len(w) for w in words])
        pattern = np.zeros((len(words), int(length.max()) + 2), np.int64)
        for i, w in enumerate(words):
            codes = self.code[np.frombuffer(w, np.uint8)]
            pattern[i, :len(w)] = codes if rightwards else codes[::-1]
        half = length // 2 if rightwards else length - length // 2
        every = np.arange(len(words))
        pattern[every, length] = 1  # the delimiter ends a word
        state = np.tile(np.array([[0], [0], [self.n]]), len(words))
        state = self.extend(state, np.ones(len(words), np.int64), rightwards)
        q, at, wrong = every, np.zeros(len(words), np.int64), np.zeros(len(words), bool)
        found: list = []
        while len(q):
            parts = []
            free = np.flatnonzero(~wrong & (at >= half[q]))  # may still take an error
            if len(free):
                which, symbol = self.next_symbols(state[:, free], rightwards)
                which = free[which]
                ahead = pattern[q[which], at[which]]
                which, symbol, ahead = (x[symbol != ahead] for x in (which, symbol, ahead))
                child = self.extend(state[:, which], symbol, rightwards)
                on = np.flatnonzero(child[2] > 0)
                which, child, ahead = which[on], child[:, on], ahead[on]
                parts.append((child, q[which], at[which]))                                            # one symbol more
                same = np.flatnonzero(ahead > 1)
                parts.append((child[:, same], q[which[same]], at[which[same]] + 1))                   # another symbol
                short = free[(at[free] < length[q[free]]) & (pattern[q[free], at[free]] != pattern[q[free], at[free] + 1])]
                parts.append((state[:, short], q[short], at[short] + 1))                              # one symbol less
            exact = np.flatnonzero(wrong | (at < length[q]))  # a whole word without an error is the word itself
            child = self.extend(state[:, exact], pattern[q[exact], at[exact]], rightwards)
            on = np.flatnonzero(child[2] > 0)
            exact, child = exact[on], child[:, on]
            ended = at[exact] == length[q[exact]]
            done = np.flatnonzero(ended)
            # the match begins and ends with a delimiter: its rank is that of the one before the word
            found.append((q[exact[done]], self.word[child[0, done]]))
            live = np.flatnonzero(~ended)
            parts.append((child[:, live], q[exact[live]], at[exact[live]] + 1, wrong[exact[live]]))
            wrong = np.concatenate([p[3] if len(p) > 3 else np.ones(len(p[1]), bool) for p in parts])
            state = np.concatenate([p[0] for p in parts], axis=1)
            q, at = (np.concatenate([p[k] for p in parts]) for k in (1, 2))
        return tuple(np.concatenate(x) for x in zip(*found))


def near_in_shard(table: pa.Table) -> pa.Table:
    """``word, near, near_n`` for the searches of a shard (``side, word, n, searches``; side 0: by the first half)."""
    words, at = np.unique(np.array([w.encode("latin-1") for w in table.column("word").to_pylist()], object), return_inverse=True)
    words, n = words.tolist(), np.zeros(len(words), np.int64)
    n[at] = table.column("n").to_numpy()
    indexed = np.zeros(len(words), bool)
    indexed[at[table.column("indexed").to_numpy(zero_copy_only=False)]] = True
    own = np.flatnonzero(indexed)
    side, searches = table.column("side").to_numpy(), table.column("searches").to_numpy(zero_copy_only=False)
    pairs = []
    if len(own):
        index = Index([words[k] for k in own])
        for s in (0, 1):
            asked = np.unique(at[searches & (side == s)])
            for i in range(0, len(asked), TOGETHER):
                part = asked[i:i + TOGETHER]
                a, b = index.near([words[k] for k in part], s == 0)
                pairs.append(np.stack([part[a], own[b]]))
    pairs = np.unique(np.concatenate([np.zeros((2, 0), np.int64), *pairs], axis=1), axis=1)
    text = pa.array([w.decode("latin-1") for w in words], pa.string())
    return pa.table({"word": text.take(pa.array(pairs[0])), "near": text.take(pa.array(pairs[1])), "near_n": pa.array(n[pairs[1]])})


def near_words(spark: SparkSession, vocabulary: DataFrame, shard: int = SHARD) -> DataFrame:
    """``word, near, near_n``: both directions of every near pair of ``vocabulary`` (distinct ``word``, ``n``; code points up to 255), once each."""
    size = "length(word)"
    lengths = vocabulary.select("word", "n", F.explode(F.expr(f"array({size} - 1, {size}, {size} + 1)")).alias("l"))
    halves = "explode(array(struct(0 AS side, left(word, l div 2) AS half), struct(1 AS side, right(word, l - l div 2) AS half))) AS h"
    rows = lengths.selectExpr("word", "n", f"l = {size} AS searches", halves).select("h.side", "h.half", "word", "n", "searches")
    rows = staged(spark, rows.groupBy("side", "half", "word", "n").agg(F.max("searches").alias("searches")), "halves")
    large = rows.groupBy("side", "half").count().where(F.col("count") > shard)
    large = staged(spark, large.selectExpr("side AS s_", "half AS h_", f"cast(ceil(count / {shard}) AS int) AS parts"), "large")
    split = rows.join(large, F.expr("side = s_ AND half = h_"), "left").withColumn("parts", F.expr("coalesce(parts, 1)"))
    split = split.withColumn("own", F.expr("cast(pmod(xxhash64(word), parts) AS int)"))
    split = split.withColumn("part", F.explode(F.expr("if(searches, sequence(0, parts - 1), array(own))"))).withColumn("indexed", F.expr("part = own"))
    shards = max(1, -(-rows.count() // shard))
    dealt = split.withColumn("shard", F.pmod(F.xxhash64("side", "half", "part"), F.lit(shards)))
    found = dealt.select("shard", "side", "word", "n", "searches", "indexed").groupBy("shard").applyInArrow(
        near_in_shard, "word string, near string, near_n long")
    return found.groupBy("word", "near").agg(F.first("near_n").alias("near_n"))


def roots(spark: SparkSession, forms: DataFrame) -> DataFrame:
    """``word, root`` of ``forms`` (``word, form``; no circle): the end of each word's chain."""
    now = staged(spark, forms.selectExpr("word", "form AS root"), "roots")
    for _ in range(ROUNDS):
        ahead = now.selectExpr("word AS w_", "root AS r_")
        then = now.join(ahead, F.expr("root = w_"), "left").selectExpr("word", "coalesce(r_, root) AS root", "r_ IS NOT NULL AS moved")
        then = staged(spark, then, "roots")
        if not then.where("moved").count():
            break
        now = then.drop("moved")
    return now


def spelling_variants(spark: SparkSession, docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT,
                      ratio: int = RATIO, delete: int = DELETE, shard: int = SHARD) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every word of all texts (see ``word_counts``) that comes at least ``least_count`` times.

    A word's form is its near word of largest n (of equals the smallest in
    code-point order) if that n is at least ``ratio`` times its own; its root is
    the last of the forms from it on.  Null and empty texts have no word; a null id
    counts as empty; repeated rows count as often as they come.  Tables without a
    word give an empty result; other columns are not read.
    """
    if ratio < 2:
        raise ValueError("ratio must be at least 2, so that no chain of forms comes back")
    bounded_batches(spark)
    words = staged(spark, word_counts(docs, least_length, delete).where(F.col("n") >= least_count), "words")
    best = near_words(spark, words, shard).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("m"), "near")).alias("best"))
    best = staged(spark, best.selectExpr("word AS w_", "n_near", "best.near AS near", "-best.m AS near_n"), "near")
    found = words.join(best, F.expr("word = w_"), "left").withColumn("has", F.expr(f"coalesce(near_n >= {ratio} * n, false)"))
    found = staged(spark, found.selectExpr("word", "if(has, near, NULL) AS form", "n", "coalesce(n_near, 0L) AS n_near", "if(has, near_n, NULL) AS form_n"), "forms")
    last = roots(spark, found.where("form IS NOT NULL").select("word", "form")).selectExpr("word AS w_", "root")
    return found.join(last, F.expr("word = w_"), "left").selectExpr("word", "form", "coalesce(root, word) AS root", "n", "n_near", "form_n")
