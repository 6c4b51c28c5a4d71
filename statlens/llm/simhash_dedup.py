"""SimHash near-dedup with BK-trees.

1. Each text gets a 64-bit SimHash of its word shingles.
2. Distinct fingerprints are dealt to shards.  Fingerprints that differ in at
   most ``r`` bits agree on at least ``blocks - r`` of ``blocks`` bit blocks, so
   every choice of ``blocks - r`` blocks is one shard key and each link falls into
   some shard.  A shard larger than ``shard`` is split into pieces, and every
   two pieces meet in one unit, so no unit holds more than about two pieces.
3. A task builds the BK-trees of its units (a child is keyed by its Hamming
   distance to its parent) and sends each fingerprint down its unit's tree,
   following only edges within the radius of the distance found.  A unit gives
   at most one edge per fingerprint, to the smallest member of its group.
4. The edges are joined up by alternating large-star and small-star passes,
   each written as a table.

A shard tree goes only to the fingerprints that can have a link in it, through
the shuffle: a broadcast of all trees would pass every fingerprint through the
driver and grow with the corpus.
"""

from __future__ import annotations

from itertools import accumulate, combinations
from typing import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statlens.llm.common import bounded_batches, drop_rows, row_key, staged, text_key

SHINGLE, RADIUS, SEED = 3, 3, 42
BLOCKS, SHARD = 5, 4096
U64 = np.uint64


def fingerprint(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """SimHash of the shingles of ``text`` (A-Z lower-cased, words between ASCII blanks)."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) < shingle:
        return digest(joined, seed)
    ends = list(accumulate(len(w) + 1 for w in words))
    starts = [0, *ends]
    hashes = np.array([digest(joined[a:b - 1], seed) for a, b in zip(starts, ends[shingle - 1:])], dtype="<u8")
    return majority(hashes)


def majority(hashes: np.ndarray, block: int = 1 << 16) -> int:
    """The bits that are set in over half of the hashes."""
    counts = np.zeros(64, np.int64)
    for i in range(0, len(hashes), block):
        part = hashes[i:i + block]
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view("<u8")[0])


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 shingle: int = SHINGLE, seed: int = SEED, every: bool = False) -> DataFrame:
    """``doc_id, fp`` (the fingerprint's bits as a signed long) of every row with an id; null text: empty.

    With ``every`` the ``row_key`` and ``fp`` of all rows.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield b.drop(columns="t").assign(fp=[signed(fingerprint(t, shingle, seed)) for t in b["t"]])

    bounded_batches(docs.sparkSession)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("t")
    if every:
        return docs.select(*row_key(id_col, text_col), text).mapInPandas(run, "given boolean, d long, t1 long, t2 long, fp long")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text)
    return rows.where("doc_id IS NOT NULL").mapInPandas(run, "doc_id long, fp long")


def shard_masks(blocks: int = BLOCKS, radius: int = RADIUS) -> list[int]:
    """A mask for every choice of ``blocks - radius`` of the ``blocks`` bit blocks."""
    if blocks <= radius:
        raise ValueError("blocks must exceed radius")
    edges = [round(i * 64 / blocks) for i in range(blocks + 1)]
    one = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:])]
    return [sum(c) for c in combinations(one, blocks - radius)]


class Forest:
    """BK-trees of many units at once; ``unit`` is sorted and tells which tree a fingerprint is in."""

    def __init__(self, unit: np.ndarray, fps: np.ndarray):
        n = len(fps)
        self.fps, self.edge = fps, np.zeros(n, np.int64)
        first = np.flatnonzero(np.r_[True, unit[1:] != unit[:-1]]) if n else np.zeros(0, np.int64)
        self.root = np.repeat(first, np.diff(np.r_[first, n]))
        parent = np.full(n, -1, np.int64)
        at = self.root.copy()
        todo = np.flatnonzero(np.arange(n) != at)
        while len(todo):  # every pass hangs the first item of each (node, distance) and sends the rest below it
            d = np.bitwise_count(fps[todo] ^ fps[at[todo]]).astype(np.int64)
            _, lead, back = np.unique(at[todo] * 65 + d, return_index=True, return_inverse=True)
            child = todo[lead]
            parent[child], self.edge[child] = at[child], d[lead]
            at[todo] = child[back]
            rest = np.ones(len(todo), bool)
            rest[lead] = False
            todo = todo[rest]
        hung = np.flatnonzero(parent >= 0)
        self.child = hung[np.argsort(parent[hung], kind="stable")]
        self.start = np.searchsorted(parent[self.child], np.arange(n + 1))

    def near(self, queries: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Arrays of (query, member) within the radius, a level of the trees at a time."""
        q, node = queries, self.root[queries]
        while len(q):
            d = np.bitwise_count(self.fps[q] ^ self.fps[node]).astype(np.int64)
            hit = d <= radius
            yield q[hit], node[hit]
            n = self.start[node + 1] - self.start[node]
            q, d = np.repeat(q, n), np.repeat(d, n)
            step = np.arange(len(q)) - np.repeat(np.cumsum(n) - n, n)
            child = self.child[np.repeat(self.start[node], n) + step]
            follow = np.abs(self.edge[child] - d) <= radius
            q, node = q[follow], child[follow]


def merge(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Join the sets of each a[i] and b[i]; labels point to the smallest member and are kept flat."""
    while True:
        x, y = label[a], label[b]
        off = x != y
        if not off.any():
            return
        a, b, x, y = a[off], b[off], x[off], y[off]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while not np.array_equal(flat := label[label], label):
            label[:] = flat


def unit_edges(unit: np.ndarray, fps: np.ndarray, radius: int, block: int = 2048) -> tuple[np.ndarray, np.ndarray]:
    """(member, smallest member of its group) of fingerprints linked within their units."""
    order = np.lexsort((fps, unit))
    unit, fps = unit[order], fps[order]
    forest, label = Forest(unit, fps.view(U64)), np.arange(len(fps))
    for i in range(0, len(fps), block):
        for a, b in forest.near(np.arange(i, min(i + block, len(fps))), radius):
            merge(label, a, b)
    moved = np.flatnonzero(label != np.arange(len(fps)))
    return fps[moved], fps[label[moved]]


def links(spark: SparkSession, fps: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS, shard: int = SHARD) -> DataFrame:
    """Edges ``u, v`` (fingerprints) that join all distinct ``fps`` linked within ``radius`` bits."""
    masks = ", ".join(f"struct({i} AS t, fp & {signed(m)} AS k)" for i, m in enumerate(shard_masks(blocks, radius)))
    keyed = staged(spark, fps.selectExpr("fp", f"explode(array({masks})) AS s").selectExpr("fp", "s.t AS t", "s.k AS k"), "shards")
    sizes = keyed.groupBy("t", "k").count().where("count > 1")
    sizes = staged(spark, sizes.selectExpr("t AS t_", "k AS k_", f"cast(ceil(count / {shard}) AS int) AS pieces"), "sizes")
    placed = keyed.join(sizes, F.expr("t = t_ AND k = k_")).selectExpr(
        "fp", "t", "k", "pieces", "cast(pmod(xxhash64(fp, t), pieces) AS int) AS p")
    units = placed.selectExpr("fp", "t", "k", "p", "pieces", "explode(sequence(0, pieces - 1)) AS o").where(
        "pieces = 1 OR o <> p").selectExpr("fp", "xxhash64(t, k, least(p, o), greatest(p, o)) AS unit")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held_u, held_f = np.zeros(0, np.int64), np.zeros(0, np.int64)

        def edges(u, f):
            a, b = unit_edges(u, f, radius)
            return pd.DataFrame({"u": a, "v": b}).drop_duplicates()

        for b in batches:  # sorted by unit: all but the last unit of a batch are whole
            u, f = np.r_[held_u, b["unit"].to_numpy()], np.r_[held_f, b["fp"].to_numpy()]
            whole = np.searchsorted(u, u[-1]) if len(u) else 0
            if whole:
                yield edges(u[:whole], f[:whole])
            held_u, held_f = u[whole:], f[whole:]
        if len(held_u):
            yield edges(held_u, held_f)

    dealt = units.repartition("unit").sortWithinPartitions("unit")
    return staged(spark, dealt.mapInPandas(run, "u long, v long").distinct(), "links")


def components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges`` (``u, v``): root is the smallest node it is joined to.

    Alternating large-star and small-star passes; each is one grouped minimum and
    one equi-join, written as a table.  They end when a pass changes nothing.
    """
    def star(e: DataFrame, large: bool) -> DataFrame:
        both = e.select("u", "v").union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        if not large:
            both = both.where("v < u")
        low = both.groupBy("u").agg(F.min("v").alias("m"))
        low = low.selectExpr("u AS u_", "least(u, m) AS m")
        joined = both.join(low, F.expr("u = u_"))
        if large:
            out = joined.where("v > u").selectExpr("v AS u", "m AS v")
        else:
            out = joined.selectExpr("v AS u", "m AS v").union(low.selectExpr("u_ AS u", "m AS v"))
        return out.where("u <> v").distinct()

    def state(e: DataFrame):
        return e.selectExpr("count(1)", "bit_xor(xxhash64(u, v))").first()

    edges = staged(spark, edges.selectExpr("greatest(u, v) AS u", "least(u, v) AS v").where("u <> v").distinct(), "stars")
    seen = state(edges)
    while seen[0]:
        edges = staged(spark, star(staged(spark, star(edges, True), "large"), False), "stars")
        now = state(edges)
        if now == seen:
            break
        seen = now
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)


def groups(spark: SparkSession, prints: DataFrame, me: str, radius: int = RADIUS, blocks: int = BLOCKS, shard: int = SHARD) -> DataFrame:
    """``f_, component_id``: for every fingerprint of ``prints`` the smallest ``me`` of all rows that it is joined to."""
    distinct = staged(spark, prints.groupBy("fp").agg(F.min(F.expr(me)).alias("least_id")), "distinct")
    roots = components(spark, links(spark, distinct.select("fp"), radius, blocks, shard))
    rooted = distinct.join(roots, F.col("fp") == F.col("node"), "left").selectExpr("fp", "least_id", "coalesce(root, fp) AS root")
    lowest = rooted.groupBy("root").agg(F.min("least_id").alias("component_id")).withColumnRenamed("root", "r_")
    named = rooted.join(lowest, F.col("root") == F.col("r_")).selectExpr("fp AS f_", "component_id")
    return staged(spark, named, "components")


def near_duplicates(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = SHINGLE, radius: int = RADIUS, seed: int = SEED,
                    blocks: int = BLOCKS, shard: int = SHARD) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, fp, component_id``.

    ``component_id`` is the smallest id among all rows whose fingerprints are
    joined by links of at most ``radius`` bits.  Null and empty texts, and texts
    of blanks, have fingerprint zero and are linked like any other.  A row
    without an id takes no part and is not returned.  Rows that repeat an id are
    returned as often as they come.  An empty table gives an empty result; other
    columns are not read.
    """
    prints = staged(spark, fingerprints(docs, id_col, text_col, shingle, seed), "prints")
    named = groups(spark, prints, "doc_id", radius, blocks, shard)
    return prints.join(named, F.col("fp") == F.col("f_")).select("doc_id", "fp", "component_id")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` without those whose group has a smaller id, or the same id with another text.

    Rows without an id are grouped like others and come last in the order.  Of
    texts under one id, or without one, the one with the smallest hash comes
    first; rows that repeat an id with an equal text share its decision.
    """
    prints = staged(spark, fingerprints(docs, every=True), "prints")
    me = "struct(NOT given AS late, d, t1, t2)"
    found = prints.join(groups(spark, prints, me), F.col("fp") == F.col("f_")).where(f"{me} <> component_id")
    gone = staged(spark, found.selectExpr("if(given, d, NULL) AS doc_id", "t1", "t2"), "near")
    return drop_rows(docs, gone, text_key())
