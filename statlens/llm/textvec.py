"""Words and word hashes of many texts at once, with numpy over their UTF-8 bytes."""

from __future__ import annotations

from typing import Iterator

import numpy as np

U64 = np.uint64
#: An odd base, its inverse modulo 2^64, and the odd multipliers of a shingle's words.
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
MULTIPLIERS = np.array([pow(0xD6E8FEB86659FD93, i + 1, 1 << 64) for i in range(16)], U64)

_byte = np.arange(256, dtype=np.uint8)
#: A-Z to a-z.
FOLD = np.where((_byte >= 65) & (_byte <= 90), _byte + 32, _byte).astype(np.uint8)
#: Bytes of words: digits, letters and whatever is outside ASCII.
IS_WORD = ((_byte >= 48) & (_byte <= 57)) | ((FOLD >= 97) & (FOLD <= 122)) | (_byte >= 128)

#: For ``bytes.translate``: A-Z lower-cased, a blank for every byte outside words.
WORD_TABLE = bytes(np.where(IS_WORD, FOLD, 32).astype(np.uint8))


def word_runs(text: bytes, limit: int = 1 << 19) -> Iterator[list[bytes]]:
    """The words of ``text`` in order, A-Z lower-cased, about ``limit`` bytes of text at a time."""
    at = 0
    while at < len(text):
        end = min(at + limit, len(text))
        while end < len(text) and IS_WORD[text[end]]:  # a word is never cut
            end += 1
        yield text[at:end].translate(WORD_TABLE).split()
        at = end


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of each 64-bit value."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


#: Bytes of text whose words are hashed at once; a longer text is taken in segments.
SEGMENT = 1 << 19
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base^0 .. base^(n-1) modulo 2^64; a worker keeps at most ``2 * SEGMENT`` of them a base."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        have = np.full(max(n, 1 << 16), base, U64)
        have[0] = 1
        have = np.multiply.accumulate(have)
        if len(have) <= 2 * SEGMENT:
            _powers[base] = have
    return have[:n]


def slices(sizes: list[int], limit: int) -> Iterator[slice]:
    """Runs of texts whose bytes add up to about ``limit`` at most (a longer text is a run by itself)."""
    start = total = 0
    for i, n in enumerate(sizes):
        if i > start and total + n > limit:
            yield slice(start, i)
            start, total = i, 0
        total += n
    if start < len(sizes):
        yield slice(start, len(sizes))


def words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word, number of the text it is in), in order; A-Z lower-cased."""
    joined = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    inside = np.empty(len(joined) + 1, bool)
    inside[0] = False
    inside[1:] = IS_WORD[joined]
    turns = np.flatnonzero(inside[1:] != inside[:-1])
    start, end = turns[::2], turns[1::2]
    value = mix(np.arange(1, 257, dtype=U64))[FOLD[joined]]
    sums = np.zeros(len(joined) + 1, U64)
    np.cumsum(value * powers(BASE, len(joined)), out=sums[1:])
    hashes = mix((sums[end] - sums[start]) * powers(INVERSE, len(joined))[start] + (end - start).astype(U64))
    ends = np.cumsum([len(t) + 1 for t in texts])
    return hashes, np.searchsorted(ends, start, side="right")


def segments(text: bytes, limit: int = SEGMENT) -> Iterator[tuple[int, int]]:
    """Ranges of at most ``limit`` bytes that hold whole words; a longer word is a range by itself."""
    at, n = 0, len(text)
    while at < n:
        end = min(at + limit, n)
        if end < n and IS_WORD[text[end]] and IS_WORD[text[end - 1]]:
            outside = np.flatnonzero(~IS_WORD[np.frombuffer(text, np.uint8, end - at, at)])
            if len(outside):
                end = at + int(outside[-1]) + 1
            else:
                while end < n:
                    part = np.frombuffer(text, np.uint8, min(limit, n - end), end)
                    outside = np.flatnonzero(~IS_WORD[part])
                    end += int(outside[0]) if len(outside) else len(part)
                    if len(outside):
                        break
        yield at, end
        at = end


def long_word(text: bytes, limit: int = SEGMENT) -> np.ndarray:
    """What ``words`` gives for a single word, taken ``limit`` bytes at a time."""
    value, total = mix(np.arange(1, 257, dtype=U64))[FOLD], np.zeros(1, U64)
    for at in range(0, len(text), limit):
        part = value[np.frombuffer(text, np.uint8, min(limit, len(text) - at), at)]
        total += (part * powers(BASE, len(part))).sum(keepdims=True) * U64(pow(BASE, at, 1 << 64))
    return mix(total + U64(len(text)))


def text_shingles(texts: list[bytes], size: int, limit: int = SEGMENT) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
    """(some texts, hash, number among them) of every run of ``size`` words, at most ``limit`` bytes of text at a time.

    A longer text comes by itself, each of its hashes once.
    """
    for part in slices([len(t) for t in texts], limit):
        own = texts[part]
        if len(own) > 1 or len(own[0]) <= limit:
            yield part, *shingles(*words(own), size)
            continue
        found, tail = [], np.zeros(0, U64)
        for a, e in segments(own[0], limit):
            h = words([own[0][a:e]])[0] if e - a <= limit else long_word(own[0][a:e], limit)
            h = np.concatenate([tail, h])
            found.append(np.unique(shingles(h, np.zeros(len(h), np.int64), size)[0]))
            tail = h[max(0, len(h) - size + 1):]
        h = np.unique(np.concatenate(found))
        yield part, h, np.zeros(len(h), np.int64)


def shingles(hashes: np.ndarray, text: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text) of every run of ``size`` words within a text."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, U64), np.zeros(0, np.int64)
    total = np.zeros(n, U64)
    for i in range(size):
        total += hashes[i:i + n] * MULTIPLIERS[i]
    whole = text[:n] == text[size - 1:size - 1 + n]
    return mix(total[whole]), text[:n][whole]
