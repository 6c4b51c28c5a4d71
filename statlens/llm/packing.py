"""Best-fit packing of token pieces into sequences by a grouping genetic algorithm.

Documents are tokenised and cut into pieces of at most ``CAPACITY`` tokens (only
longer documents are cut).  Pieces are dealt to shards of bounded size; each
shard is solved on several islands (own seed, own population), a group of rows
each.  A chromosome is a whole packing; crossover injects well-filled bins of
one parent into the other, takes out the bins that hold the same pieces, and
best-fits the pieces that this displaces.  After an epoch each island's elite
goes to the next island of its shard through the shuffle.  An island stops when
its packing needs no more bins than the token count asks for.

Well-filled bins of a shard's best island are final.  The pieces of the others
meet in fewer shards on the next level, so the loss to half-empty bins is that
of the last shard, not one bin of every shard.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from typing import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statlens.llm.common import bounded_batches, staged
from statlens.llm.word_tokens import text_blocks, word_tokenizer

TOKENIZER = "word_bpe_49k.json"
CAPACITY, END_ID = 4096, 1
#: Bytes of text tokenised at once, and word parts of one generation that a worker keeps (about 110 bytes each).
TEXT_BLOCK, KEPT = 4 << 20, 300_000
#: Pieces of a shard, islands of a shard, epochs (migrations between them), population, generations an epoch.
SHARD, ISLANDS, EPOCHS, POPULATION, GENERATIONS = 4096, 3, 2, 6, 6
#: From this fill on a bin is well-filled: it is injected by crossover and final at the end of a level.
WELL_FILLED = 0.99
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def token_pieces(docs: DataFrame, tokenizer: str = TOKENIZER, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """The pieces of every row of ``docs``; a null text counts as empty (its one token is ``end_id``)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, end = word_tokenizer(tokenizer, KEPT), np.array([end_id], "<u4").tobytes()
        for b in text_blocks(batches, "t", TEXT_BLOCK):
            ids, ends = words.encode(b.column("t"))
            size = np.diff(ends, prepend=0) + 1
            pieces = -(-size // capacity)
            doc = np.repeat(np.arange(len(size)), pieces)
            piece = np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            length = np.minimum(capacity, size[doc] - piece * capacity)
            view, at = memoryview(ids).cast("B"), ((ends + 1 - size)[doc] + piece * capacity)
            # a document's last piece ends with the end token
            last = piece + 1 == pieces[doc]
            crc = [zlib.crc32(end, zlib.crc32(view[4 * a:4 * (a + n - 1)])) if z else zlib.crc32(view[4 * a:4 * (a + n)])
                   for a, n, z in zip(at.tolist(), length.tolist(), last.tolist())]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id").take(pa.array(doc)), *map(pa.array, (piece, piece * capacity, length, crc))],
                schema=pa.schema([(c.split()[0], pa.int64()) for c in PIECES.replace("int", "long").split(", ")]))

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("t"))
    return rows.mapInArrow(run, PIECES.replace("int", "long")).withColumn("piece", F.col("piece").cast("int"))


def best_fit(order: np.ndarray, size: list[int], room: dict[int, int], bins: list[int], capacity: int, fresh: int) -> int:
    """Put each piece of ``order`` into the open bin that it fills best; returns the next free bin number.

    ``room`` (free space by open bin) and ``bins`` (bin by piece) are changed.
    """
    free = sorted((v, k) for k, v in room.items() if v)
    for i in order:
        s = size[i]
        at = bisect_left(free, (s, -1))
        if at < len(free):
            left, b = free.pop(at)
        else:
            left, b = capacity, fresh
            fresh += 1
        bins[i], left = b, left - s
        if left:
            insort(free, (left, b))
    return fresh


def fitness(bins: np.ndarray, size: np.ndarray, capacity: int) -> tuple[int, float]:
    """(number of bins, minus the mean squared fill): smaller is better."""
    load = np.bincount(bins, size)
    load = load[load > 0]
    return len(load), -float(np.mean((load / capacity) ** 2))


def cross(a: np.ndarray, b: np.ndarray, size: np.ndarray, capacity: int, rng: np.random.Generator) -> np.ndarray:
    """A child of ``a`` with well-filled bins of ``b`` in it."""
    load = np.bincount(b, size)
    well = np.flatnonzero(load >= WELL_FILLED * capacity)
    if not len(well):
        well = np.flatnonzero(load == load.max())
    take = np.zeros(len(load), bool)
    take[rng.permutation(well)[: max(1, len(well) // 2)]] = True
    inside = take[b]
    hit = np.zeros(a.max() + 1, bool)
    hit[a[inside]] = True  # bins of a that hold an injected piece go
    displaced = np.flatnonzero(hit[a] & ~inside)
    child = a.copy()
    child[inside] = b[inside] + a.max() + 1
    stay = np.flatnonzero(~hit[a])
    load_a = np.bincount(a[stay], size[stay])
    room = {int(k): int(capacity - load_a[k]) for k in np.unique(a[stay])}
    out = child.tolist()
    best_fit(displaced[np.argsort(-size[displaced], kind="stable")], size.tolist(), room, out, capacity, int(child.max()) + 1)
    return np.unique(np.array(out), return_inverse=True)[1]


def evolve(size: np.ndarray, elites: list[np.ndarray], capacity: int, seed: int,
           population: int = POPULATION, generations: int = GENERATIONS) -> np.ndarray:
    """The best packing (bin by piece) that an island finds, from best-fit packings and the ``elites`` that came to it."""
    rng, n, sizes = np.random.default_rng(seed), len(size), size.tolist()
    least = -(-int(size.sum()) // capacity)
    score = lambda x: fitness(x, size, capacity)

    def packed(order):
        bins = [0] * n
        best_fit(order, sizes, {}, bins, capacity, 0)
        return np.array(bins)

    people = [np.unique(e, return_inverse=True)[1] for e in elites] or [packed(np.argsort(-size, kind="stable"))]
    people.sort(key=score)
    if score(people[0])[0] <= least:
        return people[0]
    while len(people) < population:  # best fit in a disturbed decreasing order
        people.append(packed(np.argsort(-size * rng.uniform(0.8, 1.0, n), kind="stable")))
    people.sort(key=score)
    for _ in range(generations):
        if score(people[0])[0] <= least:
            break
        i, j = rng.permutation(len(people))[:2]
        children = [cross(people[i], people[j], size, capacity, rng), cross(people[j], people[i], size, capacity, rng)]
        people = sorted(people + children, key=score)[:population]
    return people[0]


def pack(spark: SparkSession, pieces: DataFrame, capacity: int = CAPACITY, shard: int = SHARD,
         islands: int = ISLANDS, epochs: int = EPOCHS) -> DataFrame:
    """``pieces`` (with ``length`` of 1 to ``capacity``) plus ``sequence_id`` and ``offset``.

    Every piece is placed once, a sequence's pieces lie in it without gaps from 0
    and add up to at most ``capacity``.  Repeated rows are pieces of their own;
    no piece gives an empty result.  Columns ``rid``, ``sequence_id`` and ``offset``
    of the input are replaced.
    """
    names = [c for c in pieces.columns if c not in ("rid", "sequence_id", "offset")]
    kept = staged(spark, pieces.select(*names).withColumn("rid", F.monotonically_increasing_id()), "pieces")
    rest = kept.select("rid", F.col("length").cast("int").alias("size"))
    total, level, done = rest.count(), 0, None
    while total:
        shards = -(-total // shard)
        best = staged(spark, solve(spark, rest, shards, level, capacity, islands, epochs), "packed")
        load = best.groupBy("shard", "bin").agg(F.sum("size").alias("load"))
        final = F.lit(True) if shards == 1 else F.col("load") >= WELL_FILLED * capacity
        loads = staged(spark, load.select(F.col("shard").alias("s_"), F.col("bin").alias("b_"), final.alias("final")), "loads")
        placed = best.join(loads, F.expr("shard = s_ AND bin = b_"))
        left = placed.where("NOT final").count()
        if -(-left // shard) >= shards:  # sizes that don't fill bins well: there would be no fewer shards
            placed, left = placed.withColumn("final", F.lit(True)), 0
        part = placed.where("final").selectExpr("rid", f"{level} * (1L << 56) + shard * (1L << 24) + bin AS sequence_id", "offset")
        done = part if done is None else done.union(part)
        rest, total, level = placed.where("NOT final").select("rid", "size"), left, level + 1
    if done is None:
        return kept.selectExpr(*[f"`{c}`" for c in names], "0L AS sequence_id", "0L AS offset")
    done = done.withColumnRenamed("rid", "r_")
    return kept.join(done, F.col("rid") == F.col("r_")).select(*[F.col(f"`{c}`") for c in names], "sequence_id", "offset")


def solve(spark: SparkSession, rest: DataFrame, shards: int, level: int, capacity: int, islands: int, epochs: int) -> DataFrame:
    """``rid, size, shard, bin, offset`` of every shard's best island."""
    dealt = rest.select("rid", "size", F.pmod(F.xxhash64("rid", F.lit(level)), F.lit(shards)).alias("shard"))
    state = dealt.select("*", F.explode(F.sequence(F.lit(0), F.lit(islands - 1))).alias("island"),
                         F.lit(-1).alias("own"), F.lit(-1).alias("guest"))

    def island(epoch: int):
        def run(key, g: pd.DataFrame) -> pd.DataFrame:
            g = g.sort_values(["size", "rid"], ascending=[False, True], kind="stable").reset_index(drop=True)
            size = g["size"].to_numpy().astype(np.int64)
            elites = [e for e in (g["own"].to_numpy(), g["guest"].to_numpy()) if len(e) and e[0] >= 0]
            bins = evolve(size, elites, capacity, 1_000_003 * epoch + 1009 * int(key[1]) + int(key[0]) % 997)
            count, spread = fitness(bins, size, capacity)
            g["own"], g["count"], g["spread"] = bins.astype(np.int32), count, spread
            g["offset"] = g.groupby("own")["size"].cumsum() - g["size"]
            return g[["rid", "size", "shard", "island", "own", "count", "spread", "offset"]]
        return run

    for epoch in range(epochs):
        evolved = staged(spark, state.groupBy("shard", "island").applyInPandas(
            island(epoch), "rid long, size int, shard long, island int, own int, count int, spread double, offset long"), "islands")
        if epoch + 1 < epochs:  # each island's elite visits the next island
            visit = evolved.selectExpr("rid AS r_", f"(island + 1) % {islands} AS i_", "own AS guest")
            state = evolved.join(visit, F.expr("rid = r_ AND island = i_")).select("rid", "size", "shard", "island", "own", "guest")
    best = evolved.groupBy("shard").agg(F.min(F.struct("count", "spread", "island")).alias("b"))
    best = best.select(F.col("shard").alias("s_"), F.col("b.island").alias("i_"))
    return evolved.join(best, F.expr("shard = s_ AND island = i_")).selectExpr("rid", "size", "shard", "own AS bin", "offset")


def packed_documents(spark: SparkSession, docs: DataFrame, tokenizer: str = TOKENIZER, capacity: int = CAPACITY) -> DataFrame:
    """Tokenise, cut and pack ``docs``: a row per piece (see ``token_pieces`` and ``pack``).

    Null and empty texts are one end token; repeated rows are packed as often as
    they come; an empty table gives an empty result; other columns are not read.
    """
    bounded_batches(spark)
    return pack(spark, token_pieces(docs, tokenizer, capacity), capacity)
