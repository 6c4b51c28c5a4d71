"""Suffix-array dedup, depth-limited: which strings of ``LENGTH`` bytes repeat.

Removed is every byte covered by a string of ``LENGTH`` bytes that also starts
somewhere else.  The groups are those that a depth-limited radix sort of all
suffixes would end with, but nothing is sorted by digits here: successive passes
over all suffixes would shuffle each start once a pass (13 passes of 32 bytes:
for the 864 MB of text of the larger check table 11 billion rows, against
44 million rows that all steps below read).  Hash grouping of runs of starts stands in
for the passes, in three steps of growing depth, and only groups that are still
open go on:

Pass 1.  Of the suffixes starting in any ``WINDOW`` consecutive places one is the
anchor: the one whose first ``GRAM`` bytes hash lowest, the first of equals.
Equal strings have their anchor at the same place.  Starts with the same anchor
are taken in runs of at most an eighth of ``LENGTH``, dealt by their distance to
it, and the strings of a run share a core of seven eighths.  A string can repeat
only if its run's core does; runs whose core is alone go.
Pass 2.  A run stands for one context, from its first start to the end of its
last string.  Runs with an equal context: all their starts repeat.
Pass 3 (depth ``LENGTH``).  Where a group of pass 1 has several contexts, one
member of each gives all its strings; equal groups are exactly the repeated
strings.

Groups are counted by partial aggregation.  Rows whose group cannot repeat are
left out by a sieve of bounded size before they are shuffled.  Beyond pass 1,
groups are keyed by 128 bits of the string's hash.
"""

from __future__ import annotations

import hashlib
from typing import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statlens.llm.common import bounded_batches, staged
from statlens.llm.sieve import passes, sieve
from statlens.llm.textvec import BASE, U64, mix, slices

LENGTH, GRAM, WINDOW = 400, 32, 256
#: Starts of a long text handled at once, bytes of a block of texts, bits of a position in a block.
SEGMENT, BLOCK, POSITION = 1 << 20, 1 << 20, 24


def gram_hashes(joined: np.ndarray, gram: int) -> np.ndarray:
    """A hash of the ``gram`` bytes (a power of two) from every place on."""
    h, k = mix(np.arange(1, 257, dtype=U64))[joined], 1
    while k < gram:
        h = h[:-k] * U64(pow(BASE, k, 1 << 64)) + h[k:]
        k *= 2
    return h * U64(0xD6E8FEB86659FD93)


def core_size(length: int) -> int:
    return length - max(1, length // 8) + 1


def runs(texts: list[bytes], length: int = LENGTH, gram: int = GRAM, window: int = WINDOW) -> Iterator[tuple[np.ndarray, ...]]:
    """Arrays (text, core, first start, last start) of runs that cover every start of a string of ``length`` bytes."""
    wide = length - core_size(length) + 1
    parts = [(i, s) for i, t in enumerate(texts) for s in range(0, max(0, len(t) - length + 1), SEGMENT)]
    sizes = [min(len(texts[i]) - s, SEGMENT + length - 1) for i, s in parts]
    for cut in slices(sizes, BLOCK):
        own, size = parts[cut], np.array(sizes[cut])
        joined = np.frombuffer(b"".join(texts[i][s:s + n] for (i, s), n in zip(own, size.tolist())), np.uint8)
        key = gram_hashes(joined, gram) & ~U64((1 << POSITION) - 1)
        key |= np.arange(len(key), dtype=U64)
        k = 1
        while k < window:
            key = np.minimum(key[:-k], key[k:])
            k *= 2
        off = np.cumsum(size) - size
        part = np.repeat(np.arange(len(own)), size - length + 1)
        start = np.arange(len(part)) + (off - np.r_[0, np.cumsum(size - length + 1)[:-1]])[part]
        at = (key[start] & U64((1 << POSITION) - 1)).astype(np.int64)
        first = np.flatnonzero(np.r_[True, (at[1:] != at[:-1]) | (part[1:] != part[:-1])])
        last = np.r_[first[1:], len(part)] - 1
        own_part = part[first]
        text, base = np.array([i for i, _ in own])[own_part], np.array([s for _, s in own])[own_part] - off[own_part]
        a, lo, hi = at[first] + base, start[first] + base, start[last] + base
        near, n = (a - hi) // wide, (a - lo) // wide - (a - hi) // wide + 1
        which = np.repeat(np.arange(len(a)), n)
        core = a[which] - wide * (near[which] + np.arange(len(which)) - (np.cumsum(n) - n)[which])
        yield text[which], core, np.maximum(lo[which], core - wide + 1), np.minimum(hi[which], core)


def hashes64(parts: Iterable[bytes]) -> np.ndarray:
    """A long for each of the byte strings."""
    return np.frombuffer(b"".join(map(xxhash.xxh3_64_digest, parts)), ">i8").astype(np.int64)


def hashes128(parts: Iterable[bytes]) -> np.ndarray:
    """Two longs for each of the byte strings."""
    return np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, parts)), ">i8").astype(np.int64).reshape(-1, 2)


def merged(spans) -> list[tuple[int, int]]:
    """Maximal runs of the half-open ``spans``."""
    out: list[list[int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return [(s, e) for s, e in out]


def keyed(docs: DataFrame) -> DataFrame:
    """``d, t1, text``: a row's id (a null has one of its own) and its text's hash; null text: empty."""
    bounded_batches(docs.sparkSession)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("d"),
                       F.xxhash64(text).alias("t1"), text.alias("text"))


def parts(batches: Iterable[pa.RecordBatch], limit: int = 4 << 20) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Slices of the batches with their texts' bytes, about ``limit`` bytes each."""
    for b in batches:
        sizes = pc.binary_length(b.column("text")).to_pylist()
        for s in slices(sizes, limit):
            own = b.slice(s.start, s.stop - s.start)
            yield own, own.column("text").cast(pa.binary()).to_pylist()


def encode(texts) -> list[bytes]:
    return [t.encode("utf-8", "surrogatepass") for t in texts]


def repeated_spans(spark: SparkSession, docs: DataFrame, length: int = LENGTH, gram: int = GRAM, window: int = WINDOW) -> DataFrame:
    """``d, t1, spans`` (see ``keyed``): half-open byte ranges to remove, of the texts that have any."""
    depth, rows = core_size(length), keyed(docs)

    def first_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in parts(batches):
            for text, core, _, _ in runs(texts, length, gram, window):
                yield pa.RecordBatch.from_pydict({"k": hashes64(texts[i][p:p + depth] for i, p in zip(text.tolist(), core.tolist()))})

    groups = rows.select("text").mapInArrow(first_pass, "k long").groupBy("k").count().where("count > 1").select("k")
    shared = spark.sparkContext.broadcast(sieve(staged(spark, groups, "depth"), "k"))

    def second_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = shared.value
        for b, texts in parts(batches):
            d, t1 = b.column("d").to_numpy(), b.column("t1").to_numpy()
            for text, core, lo, hi in runs(texts, length, gram, window):
                k = hashes64(texts[i][p:p + depth] for i, p in zip(text.tolist(), core.tolist()))
                on = np.flatnonzero(passes(words, k))
                x = hashes128(texts[i][s:e + length] for i, s, e in zip(text[on].tolist(), lo[on].tolist(), hi[on].tolist()))
                yield pa.RecordBatch.from_pydict({"d": d[text[on]], "t1": t1[text[on]], "k": k[on], "lo": lo[on], "n": hi[on] - lo[on] + 1,
                                                  "x1": np.ascontiguousarray(x[:, 0]), "x2": np.ascontiguousarray(x[:, 1])})

    members = staged(spark, rows.select("d", "t1", "text").mapInArrow(
        second_pass, "d long, t1 long, k long, lo long, n long, x1 long, x2 long"), "members")
    classes = staged(spark, members.groupBy("k", "x1", "x2").agg(
        F.count(F.lit(1)).alias("size"), F.min(F.struct("d", "t1", "lo", "n")).alias("one")), "classes")
    several = staged(spark, classes.groupBy("k").count().where("count > 1").select(F.col("k").alias("k_")), "several")
    open_ = classes.join(several, F.expr("k = k_")).select("x1", "x2", "one.*")
    whole = classes.where("size > 1").selectExpr("x1", "x2", "0L AS a", "one.n - 1 AS b")

    # one member's context of each class that pass 3 has to look into
    places = staged(spark, open_.groupBy("d", "t1").agg(F.collect_list(F.struct("x1", "x2", "lo", "n")).alias("at")), "places")
    wanted = with_text(spark, docs, places)

    def contexts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for t, at in zip(b["text"], b["at"]):
                t = t.encode("utf-8", "surrogatepass")
                yield pd.DataFrame([(p["x1"], p["x2"], t[p["lo"]:p["lo"] + p["n"] - 1 + length]) for p in at], columns=["x1", "x2", "bytes"])

    context = staged(spark, wanted.where("at IS NOT NULL").select("text", "at").mapInPandas(contexts, "x1 long, x2 long, bytes binary").distinct(), "contexts")

    def strings(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for i in range(0, len(b), 512):
                yield pd.DataFrame({"w": hashes128(c[p:p + length] for c in b["bytes"][i:i + 512] for p in range(len(c) - length + 1))[:, 0]})

    twice = context.mapInPandas(strings, "w long").groupBy("w").count().where("count > 1").select("w")
    maybe = spark.sparkContext.broadcast(sieve(staged(spark, twice, "strings"), "w"))

    def third_pass(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = maybe.value
        for b in batches:
            for i in range(0, len(b), 512):
                own = b[i:i + 512]
                n = own["bytes"].str.len().to_numpy() - length + 1
                w = hashes128(c[p:p + length] for c in own["bytes"] for p in range(len(c) - length + 1))
                at = np.flatnonzero(passes(words, np.ascontiguousarray(w[:, 0])))
                which = np.repeat(np.arange(len(own)), n)
                place = np.arange(len(which)) - (np.cumsum(n) - n)[which]
                yield pd.DataFrame({"w1": w[at, 0], "w2": w[at, 1], "x1": own["x1"].to_numpy()[which[at]],
                                    "x2": own["x2"].to_numpy()[which[at]], "i": place[at]})

    found = staged(spark, context.mapInPandas(third_pass, "w1 long, w2 long, x1 long, x2 long, i long"), "found")
    equal = staged(spark, found.groupBy("w1", "w2").count().where("count > 1").selectExpr("w1 AS v1", "w2 AS v2"), "equal")
    part = found.join(equal, F.expr("w1 = v1 AND w2 = v2")).groupBy("x1", "x2").agg(F.sort_array(F.collect_set("i")).alias("i"))
    ends = "filter(i, (x, j) -> j = 0 OR i[j - 1] < x - 1)", "filter(i, (x, j) -> j = size(i) - 1 OR i[j + 1] > x + 1)"
    part = part.selectExpr("x1", "x2", f"inline(arrays_zip({ends[0]}, {ends[1]})) AS (a, b)")
    starts = staged(spark, whole.union(part).selectExpr("x1 AS y1", "x2 AS y2", "a", "b"), "starts")
    spans = members.join(starts, F.expr("x1 = y1 AND x2 = y2")).selectExpr("d", "t1", "lo + a AS s", f"lo + b + {length} AS e")
    return staged(spark, spans.groupBy("d", "t1").agg(F.collect_set(F.struct("s", "e")).alias("spans")), "spans")


def with_text(spark: SparkSession, docs: DataFrame, found: DataFrame, all_texts: bool = False) -> DataFrame:
    """Rows of ``docs`` with what ``found`` (by ``d, t1``) has for them; only texts that may be found are shuffled.

    ``doc_id, n_bytes, sha256`` of every row and the columns of ``found``, null
    where it has none; ``text`` of the rows that it has, or of all.
    """
    words = spark.sparkContext.broadcast(sieve(found.select(F.xxhash64("d", "t1").alias("key")), "key"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            on, text = pa.array(passes(words.value, b.column("key").to_numpy())), b.column("text")
            if not all_texts:
                text = pc.if_else(on, text, pa.scalar(None, text.type))
            rest = ["doc_id", "d", "t1", "n_bytes", "sha256"]
            yield pa.RecordBatch.from_arrays([on, text, *(b.column(c) for c in rest)], names=["here", "text", *rest])

    rows = keyed(docs).withColumns({"key": F.xxhash64("d", "t1"), "n_bytes": F.octet_length("text").cast("long"), "sha256": F.sha2("text", 256)})
    rows = rows.mapInArrow(run, "here boolean, text string, doc_id long, d long, t1 long, n_bytes long, sha256 string")
    found = found.withColumnsRenamed({"d": "d_", "t1": "t_"})
    joined = rows.where("here").join(found, F.expr("d = d_ AND t1 = t_"), "left").drop("d_", "t_")
    return joined.unionByName(rows.where("NOT here"), allowMissingColumns=True).drop("here")


def dedup_bytes(spark: SparkSession, docs: DataFrame, length: int = LENGTH, gram: int = GRAM, window: int = WINDOW) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans``.

    Bytes are those of the text in UTF-8 (null: empty); strings never cross
    documents; ``spans`` are the maximal removed half-open ranges (empty array:
    none).  A row is a document, so rows that repeat an id and text repeat each
    other's strings; a null id is an id.  Texts shorter than ``length`` lose
    nothing.  An empty table gives an empty result; other columns are not read.
    """
    if window + gram - 1 > length or gram & (gram - 1) or window & (window - 1):
        raise ValueError("gram and window must be powers of two and fit into length")
    rows = with_text(spark, docs, repeated_spans(spark, docs, length, gram, window))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for n, sha, text, spans in zip(b["n_bytes"], b["sha256"], b["text"], b["spans"]):
                if spans is None:
                    out.append((0, 0, sha, []))
                    continue
                t, cut = text.encode("utf-8", "surrogatepass"), merged((int(x["s"]), int(x["e"])) for x in spans)
                digest, at = hashlib.sha256(), 0
                for s, e in cut:
                    digest.update(t[at:s])
                    at = e
                digest.update(t[at:])
                out.append((sum(e - s for s, e in cut), len(cut), digest.hexdigest(), [{"s": s, "e": e} for s, e in cut]))
            got = pd.DataFrame(out, columns=["n_removed", "n_spans", "kept_sha256", "spans"], index=b.index)
            yield pd.concat([b["doc_id"].astype("Int64"), b["n_bytes"], got], axis=1)

    return rows.select("doc_id", "n_bytes", "sha256", "text", "spans").mapInPandas(
        run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<s: long, e: long>>")
