"""An adaptive range coder for token ids, in independent blocks, with numpy.

A block has its own model, which starts empty, so any block decodes alone.  Its
ids are cut into up to ``LANES`` segments; a step codes the next id of every
segment with the model as it was before the step, then the model learns them
all.  So many ids pass through one set of numpy operations, and several blocks
are coded side by side (their models never meet).

Four predictions of the next id are mixed:
* order 2: one id by the two ids before it (hashed), with a confidence;
* order 1: one id by the id before it, with a confidence;
* order 0: how often each id came so far in the block, made anew at growing
  steps (``Model.renew``);
* all ids alike, for ids that the order-0 table does not have yet.
The weights adapt: each is the share of the cases so far, at that confidence, in
which the prediction was right after those before it were wrong.  Each id gets
one interval of the mixture, the first that holds it, and one step of a range
coder with a 64-bit interval and carries into the words already written.

A block: ids, payload bytes, CRC-32 of the ids and of the payload (little-endian
uint32 each), the words of each lane (uint16), the lanes' 32-bit words.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

LANES, BLOCK = 2048, 1 << 20
#: Bits of the mixture's weights, cases after which old ones count half.
WEIGHT_BITS, FADE = 12, 4096
#: Bits of the tables of a block: order 1, order 2 and the places of order 0.
ONE_BITS, TWO_BITS, PLACE_BITS = 14, 16, 14
#: Change of the confidence by (confidence, wrong or right); 8: the guess is replaced.
MOVE = np.array([8, 1, -1, 1, -1, 1, -1, 1, -1, 1, -1, 1, -1, 1, -1, 0], np.int64)
HEAD, HEAD_SIZE = "<4I", 16
_U = np.uint64
_FULL, _LOW = 1 << WEIGHT_BITS, _U(1 << 32)


def lane_sizes(n: int) -> np.ndarray:
    """Ids of each lane of a block of ``n``; the longest first."""
    rows = -(-n // LANES)
    return np.clip(n - rows * np.arange(LANES), 0, rows)


class Model:
    """What the blocks that are coded side by side have seen; ``bits``: ids are below ``1 << bits``.

    Guesses of orders 1 and 2 are kept as ``id << 3 | confidence``, the two orders'
    tables one after the other.  Contexts of the weights: a block, the confidences
    of both guesses, and whether the guesses agree.
    """

    def __init__(self, blocks: int, bits: int, lane: np.ndarray):
        self.blocks, self.bits, self.short = blocks, bits, bits - PLACE_BITS  # ``lane``: each lane's block
        self.base, self.base0, self.base1 = lane << bits, lane << PLACE_BITS, lane << ONE_BITS
        self.base2, self.block = (lane << TWO_BITS) + (blocks << ONE_BITS), lane << 7
        self.guess = np.zeros((blocks << ONE_BITS) + (blocks << TWO_BITS), np.int64)
        self.count = np.zeros(blocks << bits, np.int64)
        self.place = np.zeros(blocks << bits, np.int64)  # order 0: where the id's part starts << 32 | its size
        self.owner = np.zeros(blocks << PLACE_BITS, np.int64)  # the id that has a place
        self.cases = np.ones((3, blocks << 7, 2), np.int64)  # by decision and context: wrong, right
        self.rows, self.next, self.kept = 0, 2, []
        self.weigh()

    def weigh(self) -> None:
        """The weights from the cases so far: of order 2, of order 1 where 2 is wrong, of new ids where both are."""
        by = self.cases.reshape(3, self.blocks, 8, 16, 2)
        two = by[0].sum(axis=2, keepdims=True)          # order 2: by its own confidence
        one = by[1].sum(axis=1, keepdims=True)          # order 1: by its own and whether the guesses agree
        new = by[2].sum(axis=(1, 2), keepdims=True)     # new ids: by block
        share = lambda c: (c[..., 1] << WEIGHT_BITS) // c.sum(axis=-1)
        f2 = np.clip(share(two), 1, _FULL - 4) + np.zeros((self.blocks, 8, 16), np.int64)
        f1 = np.maximum((_FULL - f2) * np.clip(share(one), 1, _FULL - 4) >> WEIGHT_BITS, 1)
        left = _FULL - f2 - f1
        fn = np.clip(left * np.clip(share(new), 1, _FULL - 4) >> WEIGHT_BITS, 1, left - 1)
        self.t2, self.t1, self.tn = (x.ravel() << self.bits for x in (f2, f2 + f1, _FULL - fn))  # where the parts of the mixture end
        self.w1, self.w0, self.wn = f1.ravel() << self.bits, (left - fn).ravel(), fn.ravel()
        self.cases -= (self.cases >> 1) * (self.cases.sum(axis=2, keepdims=True) > FADE)

    def look(self, p1: np.ndarray, p2: np.ndarray) -> None:
        """Guesses and weights for the lanes whose last ids are ``p1`` and, before it, ``p2``."""
        k = len(p1)
        self.at = np.empty(2 * k, np.int64)
        np.add(p1 & ((1 << ONE_BITS) - 1), self.base1[:k], out=self.at[:k])
        np.add(p1 * 40503 + p2 * 60493 >> 3 & ((1 << TWO_BITS) - 1), self.base2[:k], out=self.at[k:])
        self.entry = self.guess.take(self.at)
        self.sure, both = self.entry & 7, self.entry >> 3
        self.c1, self.c2 = both[:k], both[k:]
        self.x = (self.c1 == self.c2) * 8
        self.x += self.sure[:k]
        self.x += self.sure[k:] << 4
        self.x += self.block[:k]
        self.e2, self.e1, self.f0 = self.t2.take(self.x), self.t1.take(self.x), self.w0.take(self.x)

    def interval(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(start, size) of the ids' parts of ``_FULL << bits``."""
        place = self.place.take(self.base[:len(ids)] + ids)
        size = place & 0xFFFFFFFF
        size *= self.f0
        start = place
        start >>= 32
        start *= self.f0
        start += self.e1
        self.new = np.flatnonzero(size == 0)
        self.hit = np.empty(2 * len(ids), bool)
        self.h1, self.h2 = self.hit[:len(ids)], self.hit[len(ids):]
        np.equal(ids, self.c1, out=self.h1)
        np.equal(ids, self.c2, out=self.h2)
        if len(self.new):
            x = self.x[self.new]
            size[self.new] = self.wn[x]
            start[self.new] = self.tn[x] + self.wn[x] * ids[self.new]
        hit = np.flatnonzero(self.h1)
        start[hit], size[hit] = self.e2.take(hit), self.w1.take(self.x.take(hit))
        hit = np.flatnonzero(self.h2)
        start[hit], size[hit] = 0, self.e2.take(hit)
        return start.view(_U), size.view(_U)

    def find(self, value: np.ndarray) -> np.ndarray:
        """The ids whose intervals hold ``value``."""
        k = len(value)
        at = (value - self.e1).view(_U) // (self.f0 << self.short).view(_U)  # beyond the places: new, or a guess
        place = np.minimum(at, _U((1 << PLACE_BITS) - 1)).view(np.int64)
        place += self.base0[:k]
        ids = self.owner.take(place)
        odd = np.flatnonzero(at >> _U(PLACE_BITS))
        v, x = value.take(odd), self.x.take(odd)
        new = (v - self.tn.take(x)) // self.wn.take(x)
        ids[odd] = np.where(v < self.e2.take(odd), self.c2.take(odd), np.where(v < self.e1.take(odd), self.c1.take(odd), new))
        return ids

    def learn(self, ids: np.ndarray) -> None:
        """Take in the ids of a step, after ``look`` and ``interval``."""
        k = len(ids)
        fresh = np.empty(2 * k, np.int64)
        np.left_shift(ids, 3, out=fresh[:k])
        fresh[k:] = fresh[:k]
        step = MOVE.take((self.sure << 1) + self.hit)  # up, down, or 8: another id's turn
        self.guess[self.at] = np.where(step > 1, fresh, self.entry + step)
        self.kept.append(self.base[:k] + ids)
        self.rows += 1
        if self.rows < 16 or self.rows % 16 == 0 or self.rows < 128 and self.rows % 4 == 0:
            self.weigh_in()
            self.weigh()
        if self.rows == self.next:
            self.renew()
            self.next += min(self.rows, 256)

    def weigh_in(self) -> None:
        """Count this step's cases."""
        n, x2, missed = len(self.x), self.x * 2, np.flatnonzero(~self.h2)
        rest = missed[~self.h1[missed]]
        new = np.zeros(n, bool)
        new[self.new] = True
        for own, at in zip(self.cases, (x2 + self.h2, (x2 + self.h1)[missed], (x2 + new)[rest])):
            own += np.bincount(at, minlength=own.size).reshape(own.shape)

    def renew(self) -> None:
        """Make the order-0 tables from the counts so far; the rarest ids stay new where there are too many."""
        self.count += np.bincount(np.concatenate(self.kept), minlength=len(self.count))
        self.kept, scale = [], 1 << PLACE_BITS
        for b in range(self.blocks):
            count = self.count[b << self.bits:b + 1 << self.bits]
            ids = np.flatnonzero(count)
            if not len(ids):
                continue
            n = count[ids]
            if len(ids) > scale >> 1:
                often = np.sort(np.argsort(-n, kind="stable")[:scale >> 1])
                ids, n = ids[often], n[often]
            size = 1 + n * (scale - len(ids)) // n.sum()
            size[np.argmax(size)] += scale - size.sum()
            place = self.place[b << self.bits:b + 1 << self.bits]
            place[:] = 0
            place[ids] = (np.cumsum(size) - size << self.short + 32) | size << self.short
            self.owner[b << PLACE_BITS:b + 1 << PLACE_BITS] = np.repeat(ids, size)


def _lanes(sizes: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ids, first id, number) of every lane of blocks of ``sizes``, the longest first."""
    n = np.concatenate([lane_sizes(s) for s in sizes])
    order = np.argsort(-n, kind="stable")
    return n[order], (np.cumsum(n) - n)[order], order


def _steps(n: np.ndarray) -> list[int]:
    """How many of the lanes, the longest first, still have ids at each step."""
    return np.searchsorted(-n, -np.arange(int(n[0])), side="left").tolist()


def encode(blocks: list[np.ndarray], bits: int = 16) -> list[bytes]:
    """The coded blocks of at most ``BLOCK`` ids each."""
    own = [np.ascontiguousarray(b, "<u4") for b in blocks]
    if not own:
        return []
    if not PLACE_BITS <= bits <= 18 or any(len(b) > BLOCK or (len(b) and int(b.max()) >> bits) for b in own):
        raise ValueError(f"blocks must have at most {BLOCK} ids, below 1 << {bits}, with bits from 14 to 18")
    n, first, lane = _lanes([len(b) for b in own])
    ids, model = np.concatenate(own).astype(np.int64), Model(len(own), bits, lane // LANES)
    out, used = np.zeros((len(n), int(n[0]) + 2), np.uint32), np.zeros(len(n), np.int64)
    low, span = np.zeros(len(n), _U), np.full(len(n), (1 << 64) - 1, _U)

    def carry(lanes):
        at = used[lanes] - 1
        while len(lanes):
            out[lanes, at] += np.uint32(1)
            on = out[lanes, at] == 0
            lanes, at = lanes[on], at[on] - 1

    p1 = p2 = np.zeros(len(n), np.int64)
    for row, k in enumerate(_steps(n)):
        now = ids[first[:k] + row]
        model.look(p1[:k], p2[:k])
        start, size = model.interval(now)
        unit = span[:k] >> _U(WEIGHT_BITS + bits)
        start *= unit
        low[:k] += start
        np.multiply(unit, size, out=span[:k])
        over = low[:k] < start
        if over.any():
            carry(np.flatnonzero(over))
        full = np.flatnonzero(span[:k] < _LOW)
        out[full, used[full]] = (low[full] >> _U(32)).astype(np.uint32)
        used[full] += 1
        low[full] <<= _U(32)
        span[full] <<= _U(32)
        model.learn(now)
        p1, p2 = now, p1
    # the last word: the least value in the interval whose lower half is zero, which the decoder fills in
    end = low + (_LOW - _U(1))
    carry(np.flatnonzero((end < low) & (n > 0)))
    out[np.arange(len(n)), used] = (end >> _U(32)).astype(np.uint32)
    used += n > 0
    coded, at = [], np.argsort(lane)
    for j, block in enumerate(own):
        lanes = at[j * LANES:(j + 1) * LANES]
        data = used[lanes].astype("<u2").tobytes() + b"".join(out[m, :used[m]].astype("<u4").tobytes() for m in lanes.tolist())
        coded.append(struct.pack(HEAD, len(block), len(data), zlib.crc32(block.tobytes()), zlib.crc32(data)) + data)
    return coded


def decode(coded: list[bytes], bits: int = 16) -> list[np.ndarray]:
    """The ids of coded blocks; raises ``ValueError`` where a checksum or a length is wrong."""
    heads = []
    for block in coded:
        if len(block) < HEAD_SIZE:
            raise ValueError("a block ends within its header")
        head = struct.unpack_from(HEAD, block)
        if len(block) - HEAD_SIZE != head[1] or zlib.crc32(block[HEAD_SIZE:]) != head[3] or head[0] > BLOCK:
            raise ValueError("the checksum of a block's payload is wrong")
        heads.append(head)
    if not coded:
        return []
    n, first, lane = _lanes([h[0] for h in heads])
    used = np.concatenate([np.frombuffer(c, "<u2", LANES, HEAD_SIZE) for c in coded]).astype(np.int64)
    words = np.concatenate([np.frombuffer(c, "<u4", -1, HEAD_SIZE + 2 * LANES) for c in coded] + [np.zeros(1, "<u4")]).astype(_U)
    end = np.cumsum(used)[lane]
    at, none = end - used[lane], len(words) - 1

    def word(lanes):
        got = words[np.where(at[lanes] < end[lanes], at[lanes], none)]
        at[lanes] += 1
        return got

    every = np.arange(len(n))
    code = word(every) << _U(32)
    code |= word(every)
    span = np.full(len(n), (1 << 64) - 1, _U)
    ids, model = np.zeros(int(n.sum()), np.int64), Model(len(coded), bits, lane // LANES)
    top, p1 = _U((_FULL << bits) - 1), np.zeros(len(n), np.int64)
    p2 = p1
    for row, k in enumerate(_steps(n)):
        model.look(p1[:k], p2[:k])
        unit = span[:k] >> _U(WEIGHT_BITS + bits)
        now = model.find(np.minimum(code[:k] // unit, top).view(np.int64))
        start, size = model.interval(now)
        start *= unit
        code[:k] -= start
        np.multiply(unit, size, out=span[:k])
        full = np.flatnonzero(span[:k] < _LOW)
        code[full] = code[full] << _U(32) | word(full)
        span[full] <<= _U(32)
        ids[first[:k] + row] = now
        model.learn(now)
        p1, p2 = now, p1
    out = np.split(ids.astype("<u4"), np.cumsum([h[0] for h in heads])[:-1])
    if any(zlib.crc32(x.tobytes()) != h[2] for x, h in zip(out, heads)):
        raise ValueError("the checksum of a block's ids is wrong")
    return out
