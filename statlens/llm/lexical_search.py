"""Ranked lexical search with hashed max-sketches.

Index.  A document's terms are hashed to the coordinates of its ``ROWS`` sketches,
with another hash for each, and each coordinate keeps the largest count of the
terms that fall on it.  A term's impact in a document grows with its count alone,
so the impact of a coordinate's maximum is the maximum of its terms' impacts,
whatever the corpus statistics are: the index (a row per document: length and
sketches) is built once, without knowing the items.  A sketch has ``SPREAD``
coordinates a distinct term, rounded up to a power of two, so long documents have
as few clashes as short ones.

Search.  The items are the stated queries; they go to the tasks in blocks of
bounded size.  No sketch shows less than a term's count, so the smallest of what
they show bounds it, and the sum of an item's weights times the impacts of these
counts is an upper bound of the document's score.
1. A scan of the index finds the ``SEEDS`` documents of highest bound for each
   item.  Their exact scores give a threshold: the ``k``-th best score so far.
2. A second scan keeps every pair of document and item whose bound reaches the
   threshold, which no document of the result can miss.
3. The texts of these documents are scored exactly, those of the highest bound
   in a batch first; a pair whose bound is below the ``k``-th best score of its
   task is skipped.
Of every task come at most ``k`` documents an item, ranked by a window.
"""

from __future__ import annotations

import math
from collections import Counter
from typing import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from statlens.llm.common import bounded_batches, row_key, staged
from statlens.llm.textvec import word_runs

TOP, SEEDS, ROWS, SPREAD, LEAST = 10, 24, 3, 8, 64
#: Bytes of item text in a block, and pairs of document and term that are looked up at once.
ITEM_BLOCK, LOOKUPS = 1 << 20, 1 << 20
#: Odd multipliers, one a sketch.
MIXERS = (0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35)
KEY = ["given", "d", "t1", "t2"]
KEY_TYPES = "given boolean, d long, t1 long, t2 long"


def term_counts(text: str) -> Counter:
    """How often each term is in the whole text."""
    out: Counter = Counter()
    for words in word_runs(text.encode("utf-8", "surrogatepass")):
        out.update(words)
    return out


def length_factor(n: int, n_docs: int, n_terms: int) -> int:
    """``m`` of a document with ``n`` of the ``n_terms`` terms of ``n_docs`` documents, in hundredths."""
    return 100 - 90 + (90 * n * n_docs) // n_terms


def impact(tf: int, m: int) -> int:
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


def weight(df: int, n_docs: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def coordinates(hashes: np.ndarray, size: int) -> list[np.ndarray]:
    """Where terms with these hashes (CRC-32) are in each of the sketches of ``size`` coordinates, which lie one after the other."""
    bits = size.bit_length() - 1
    return [k * size + ((hashes * MIXERS[k] & 0xFFFFFFFF) >> (32 - bits)) for k in range(ROWS)]


def sketch(counts: Counter) -> bytes:
    """The coordinatewise maxima of the counts in each of the sketches; 255 stands for 255 and more."""
    size = max(LEAST, 1 << (SPREAD * len(counts) - 1).bit_length())
    out = np.zeros(ROWS * size, np.uint8)
    hashes = np.fromiter(map(crc32, counts), np.int64, len(counts))
    most = np.minimum(np.fromiter(counts.values(), np.int64, len(counts)), 255).astype(np.uint8)
    np.maximum.at(out, np.concatenate(coordinates(hashes, size)), np.tile(most, ROWS))
    return out.tobytes()


def keyed(docs: DataFrame) -> DataFrame:
    return docs.select(*row_key(), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def build_index(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """``given, d, t1, t2`` (see ``row_key``), ``n`` (terms) and ``sketch`` of every row of ``docs`` that has a term; staged."""
    bounded_batches(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, out = [], []
            for text in b.column("text"):
                counts = term_counts(text.as_py())
                n.append(counts.total())
                out.append(sketch(counts) if counts else b"")
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in KEY), pa.array(n, pa.int64()), pa.array(out, pa.binary())],
                                             names=[*KEY, "n", "sketch"])

    return staged(spark, keyed(docs).mapInArrow(run, KEY_TYPES + ", n long, sketch binary").where("n > 0"), "sketches")


def document_frequencies(docs: DataFrame, terms: list[bytes]) -> list[int]:
    """How many rows of ``docs`` hold each of ``terms`` (those of a block of items)."""
    known = docs.sparkSession.sparkContext.broadcast(frozenset(terms))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for b in batches:
            for text in b.column("text"):
                found: set = set()
                for words in word_runs(text.as_py().encode("utf-8", "surrogatepass")):
                    found |= known.value.intersection(words)
                total.update(found)
        yield pa.RecordBatch.from_arrays([pa.array(total, pa.binary()), pa.array(total.values(), pa.int64())], names=["term", "n"])

    rows = keyed(docs).select("text").mapInArrow(run, "term binary, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()  # one a term
    found = {bytes(r["term"]): r["n"] for r in rows}
    return [found.get(t, 0) for t in terms]


class Items:
    """A block of items with at least one term of positive weight: their terms and weights."""

    def __init__(self, terms: list[dict[bytes, int]], n_docs: int, n_terms: int):
        self.terms, self.n_docs, self.n_terms = terms, n_docs, n_terms
        self.hash = np.array([crc32(t) for x in terms for t in x], np.int64)
        self.weight = np.array([w for x in terms for w in x.values()], np.float32)
        sizes = np.array([len(x) for x in terms])
        self.first = np.cumsum(sizes) - sizes

    def bounds(self, n: np.ndarray, sketches: list[memoryview]) -> np.ndarray:
        """The upper bound of each document's score (rows) for each item (columns)."""
        out = np.zeros((len(n), len(self.terms)), np.float32)
        size = np.array([len(s) for s in sketches])
        tf = np.arange(256, dtype=np.float64)
        for s in np.unique(size):
            at, which = coordinates(self.hash, int(s) // ROWS), np.flatnonzero(size == s)
            for i in range(0, len(which), max(1, LOOKUPS // len(self.hash))):
                own = which[i:i + max(1, LOOKUPS // len(self.hash))]
                m = np.array([length_factor(x, self.n_docs, self.n_terms) for x in n[own].tolist()], np.float64)[:, None]
                impacts = (1e9 * tf / (1000 * tf + 8 * m)).astype(np.float32)
                impacts[:, 255] = 1e6  # no count has more
                shown = np.frombuffer(b"".join(sketches[k] for k in own), np.uint8).reshape(len(own), -1)
                count = shown[:, at[0]]
                for more in at[1:]:
                    np.minimum(count, shown[:, more], out=count)
                hit = impacts.ravel().take(count + 256 * np.arange(len(own))[:, None])
                hit *= self.weight
                out[own] = np.add.reduceat(hit, self.first, axis=1)
        return out * np.float32(1.0001)  # above what single precision rounds off

    def score(self, item: int, counts: Counter, m: int) -> int:
        return sum(w * impact(counts[t], m) for t, w in self.terms[item].items() if t in counts)


def scan(index: DataFrame, stated, keep, types: str) -> DataFrame:
    """Rows that ``keep(items)`` makes of the index: it takes each batch's keys and bounds, then None at the end."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = keep(stated.value)
        for b in batches:
            sketches = [x.as_buffer() for x in b.column("sketch")]
            got = step(b.select(KEY), stated.value.bounds(b.column("n").to_numpy(), sketches))
            if got is not None:
                yield got
        got = step(None, None)
        if got is not None:
            yield got

    return index.mapInArrow(run, types)


def best_bounds(k: int):
    """For ``scan``: a row (item, bound, key) for each of a task's ``k`` highest bounds of every item."""
    def keep(items):
        held: list = [None, None, 0]  # bounds, which rows they are of, rows so far
        keys: list = []

        def step(key, bounds):
            if key is None:
                if not keys:
                    return None
                best, row = held[0], held[1]
                where = np.flatnonzero((best > 0).ravel(order="F"))
                item, place = np.divmod(where, len(best))
                table = pa.Table.from_batches(keys).combine_chunks().take(pa.array(row[place, item]))
                return pa.RecordBatch.from_arrays([pa.array(item.astype(np.int32)), pa.array(best[place, item]), *(c.combine_chunks() for c in table.columns)],
                                                  names=["item", "bound", *KEY])
            row = np.broadcast_to(np.arange(held[2], held[2] + len(bounds))[:, None], bounds.shape)
            held[2] += len(bounds)
            keys.append(key)
            if held[0] is not None:
                bounds, row = np.concatenate([held[0], bounds]), np.concatenate([held[1], row])
            if len(bounds) > k:
                top = np.argpartition(-bounds, k - 1, axis=0)[:k]
                bounds, row = np.take_along_axis(bounds, top, axis=0), np.take_along_axis(row, top, axis=0)
            held[0], held[1] = bounds, row
            if len(keys) >= 64:  # keep only the keys that are still wanted
                used, at = np.unique(held[1], return_inverse=True)
                keys[:] = [pa.Table.from_batches(keys).take(pa.array(used)).combine_chunks().to_batches()[0]]
                held[1], held[2] = at.reshape(held[1].shape), len(used)
            return None
        return step
    return keep


def reaching(least: list[int]):
    """For ``scan``: a row (key, items, bounds) for every document with items whose bound is above 0 and reaches ``least``."""
    def keep(items):
        floor = np.maximum(np.array(least, np.float64), 1e-6)

        def step(key, bounds):
            if key is None:
                return None
            on = bounds >= floor
            row = np.flatnonzero(on.any(axis=1))
            at, item = np.nonzero(on[row])
            cut = pa.array(np.searchsorted(at, np.arange(len(row) + 1)), pa.int32())
            lists = [pa.ListArray.from_arrays(cut, pa.array(x)) for x in (item.astype(np.int32), bounds[row][at, item])]
            return pa.RecordBatch.from_arrays([*(c.take(pa.array(row)) for c in key.columns), *lists], names=[*KEY, "items", "bounds"])
        return step
    return keep


def rescored(docs: DataFrame, wanted: DataFrame, stated, k: int) -> DataFrame:
    """``item, score, doc_id``: the ``k`` best documents of each task, by exact scores of the pairs in ``wanted`` (key, items, bounds)."""
    on = wanted.dropDuplicates(KEY).withColumnsRenamed({c: c + "_" for c in KEY})
    rows = keyed(docs).join(on, F.expr(" AND ".join(f"{c} = {c}_" for c in KEY))).select("given", "d", "text", "items", "bounds")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = stated.value
        best: dict[int, list] = {}

        def cut(item):
            best[item] = sorted(best[item])[:k]
            return best[item]

        for b in batches:
            given, ids, texts = b.column("given").to_pylist(), b.column("d").to_pylist(), b.column("text")
            doc, item = np.repeat(np.arange(len(b)), np.diff(b.column("items").offsets.to_numpy())), b.column("items").flatten().to_numpy()
            bound = b.column("bounds").flatten().to_numpy()
            order = np.argsort(-bound, kind="stable")
            known: dict[int, tuple[Counter, int]] = {}
            for i, q, most in zip(doc[order].tolist(), item[order].tolist(), bound[order].tolist()):
                own = best.setdefault(q, [])
                if len(own) >= 2 * k:
                    own = cut(q)
                if len(own) >= k and most < -own[k - 1][0]:
                    continue  # the first k are sorted and good enough
                if i not in known:
                    counts = term_counts(texts[i].as_py())
                    known[i] = counts, length_factor(counts.total(), block.n_docs, block.n_terms)
                score = block.score(q, *known[i])
                if score > 0:
                    own.append((-score, not given[i], ids[i]))
                    if len(own) == k:
                        own.sort()
        out = [(q, -s, None if no else d) for q in best for s, no, d in cut(q)]
        columns = list(zip(*out)) or [(), (), ()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int64(), pa.int64()))], names=["item", "score", "doc_id"])

    return rows.mapInArrow(run, "item int, score long, doc_id long")


def ranked(scores: DataFrame, k: int) -> DataFrame:
    """The first ``k`` rows of each item with their ``rank``."""
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return scores.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search(spark: SparkSession, docs: DataFrame, items: DataFrame, index: DataFrame | None = None, k: int = TOP,
           seeds: int = SEEDS, block: int = ITEM_BLOCK) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` best documents of every item with a score above 0.

    ``index`` is ``build_index(spark, docs)``, built here if it isn't given.  Equal
    scores are ranked by ascending doc_id, a null id last.  A row is a document, so
    repeated rows rank one by one.  Null and empty texts have no term: such
    documents count nowhere, such items have no row; items without an id take no
    part; rows that repeat an item_id with another text are ranked apart, equal
    rows once.  Empty tables give an empty result; other columns are not read.
    """
    bounded_batches(spark)
    index = build_index(spark, docs) if index is None else index
    n_docs, n_terms = index.agg(F.count(F.lit(1)), F.sum("n")).first()
    items = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("t")).where(
        "item_id IS NOT NULL AND length(t) > 0").distinct()
    volume = items.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    blocks = math.ceil(volume / block) if n_docs else 0
    out = spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    for i in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("item_id", "t"), F.lit(blocks)) == i).collect()
        found = search_block(spark, docs, index, rows, n_docs, n_terms, k, seeds)
        out = found if i == 0 else out.union(found)
    return out


def search_block(spark: SparkSession, docs: DataFrame, index: DataFrame, rows: list, n_docs: int, n_terms: int, k: int, seeds: int) -> DataFrame:
    """``search`` for the items of one block (rows of id and text)."""
    terms = [sorted(term_counts(r[1])) for r in rows]
    all_ = sorted({t for x in terms for t in x})
    weights = {t: weight(df, n_docs) for t, df in zip(all_, document_frequencies(docs, all_))}
    own = [(r[0], {t: weights[t] for t in x if weights[t] > 0}) for r, x in zip(rows, terms)]
    own = [(i, x) for i, x in own if x]
    if not own:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    stated = spark.sparkContext.broadcast(Items([x for _, x in own], n_docs, n_terms))

    first = scan(index, stated, best_bounds(seeds), f"item int, bound float, {KEY_TYPES}")
    order = Window.partitionBy("item").orderBy(F.desc("bound"), *KEY)
    first = first.withColumn("r", F.row_number().over(order)).where(F.col("r") <= seeds)
    first = first.dropDuplicates(["item", *KEY])  # a repeated row is found by its key as often as it comes
    first = staged(spark, first.groupBy(*KEY).agg(F.collect_list("item").alias("items"), F.collect_list("bound").alias("bounds")), "seeds")
    best = ranked(rescored(docs, first, stated, k), k).where(F.col("rank") == k).select("item", "score").collect()  # one an item
    least = dict(best)
    wanted = staged(spark, scan(index, stated, reaching([least.get(q, 0) for q in range(len(own))]),
                                KEY_TYPES + ", items array<int>, bounds array<float>"), "candidates")
    result = ranked(rescored(docs, wanted, stated, k), k)
    ids = spark.createDataFrame([(q, i) for q, (i, _) in enumerate(own)], "q_ int, item_id long")
    return result.join(F.broadcast(ids), F.expr("item = q_")).select("item_id", "rank", "doc_id", "score")  # at most a block's items
