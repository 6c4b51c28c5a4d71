"""A bitmap of bounded size that tells which keys cannot be in a set.

Rows whose key the sieve rules out need not be shuffled.  It lets some other
keys through, so an exact join follows; when a large set fills it, it lets all
keys through and costs nothing but its own size, ``MAX_BITS`` at most.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_BITS, BITS_A_KEY, LEAST_BITS = 1 << 26, 16, 1 << 12


def sieve(keys: DataFrame, column: str, max_bits: int = MAX_BITS) -> np.ndarray:
    """The bitmap (words of 64 bits) of the long ``column`` of ``keys``; at most ``max_bits / 64`` rows are fetched."""
    n, bits = keys.count(), LEAST_BITS
    while bits < min(n * BITS_A_KEY, max_bits):
        bits *= 2
    at = F.col(column).bitwiseAND(F.lit(bits - 1))
    words = keys.select(F.shiftright(at, 6).alias("w"), F.expr(f"shiftleft(1L, cast({column} & 63 AS int))").alias("b"))
    got = words.groupBy("w").agg(F.bit_or("b").alias("b")).toPandas()
    out = np.zeros(bits // 64, np.int64)
    out[got["w"].to_numpy()] = got["b"].to_numpy()
    return out.view(np.uint64)


def passes(words: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which of the keys (longs) may be in the set."""
    at = keys.view(np.uint64) & np.uint64(len(words) * 64 - 1)
    return (words[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63)) & np.uint64(1)).astype(bool)
