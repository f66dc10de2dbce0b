"""Context-mixing range coder for blocks of token ids.

A block is cut into lanes, equal runs of its ids. All lanes advance together, one id a step, each with its own range
coder and all under one model, so every step is array arithmetic. An id is coded as a choice among three
predictions (the id that last followed the two ids before it, the one that last followed the id before it, or
neither), then in the last case as itself under the adaptive order-0 counts. The chance of each choice mixes three
adaptive estimates (by both confidences, by order 2's, by order 1's), weighted by how well each has predicted. The
model learns after fixed numbers of steps and knows only ids already coded, so the decoder repeats it. It is all
integer arithmetic. Blocks share nothing.
"""

from __future__ import annotations

import zlib

import numpy as np

MAGIC = b"SVC2"
LANES = 16384
_U = np.uint64
_S12, _S32, _LOW32 = _U(12), _U(32), _U(0xFFFFFFFF)
_HASH_BITS = 18
_BUCKETS = 1 << 14


class _Model:
    """What lanes share. ``learn`` is given the ids of some steps, flat, with the contexts they were coded in."""

    def __init__(self, ids: int):
        self.follow2 = np.zeros(1 << _HASH_BITS, np.int32)  # id << 3 | confidence
        self.follow1 = np.zeros(ids, np.int32)
        self.counts = np.ones(ids, np.int64)
        self.cum = np.arange(ids + 1)  # running counts
        self.first = None
        self.seen = np.ones((128, 3), np.int64)
        self.weights = np.array([1365, 1365, 1366])
        self._mix()

    @staticmethod
    def hashed(a, b):
        return (a.view(np.uint32) * np.uint32(2654435761) + b.view(np.uint32) * np.uint32(0x9E3779B1 + 40504)) >> np.uint32(32 - _HASH_BITS)

    def predict(self, a, b):
        """What follows by orders 2 and 1 (id and confidence), the row of the choice's chances, and the place in follow2.
        a, b: the ids before, 32-bit."""
        h = self.hashed(a, b)
        two, one = self.follow2.take(h), self.follow1.take(b)
        return two, one, ((two & 7) << 4) | ((one & 7) << 1) | ((two ^ one) < 8), h

    def _mix(self):
        """Chances out of 4096 for each row, and their running sums."""
        both = self.seen
        by2 = np.repeat(both.reshape(8, 16, 3).sum(axis=1), 16, axis=0)
        by1 = np.tile(np.repeat(both.reshape(8, 8, 2, 3).sum(axis=(0, 2)), 2, axis=0), (8, 1))
        self.parts = np.stack([(x << 12) // x.sum(axis=1, keepdims=True) for x in (both, by2, by1)]) + 1
        mixed = (self.weights[:, None, None] * self.parts).sum(axis=0)
        freq = 1 + mixed * 4093 // mixed.sum(axis=1, keepdims=True)
        freq[np.arange(128), freq.argmax(axis=1)] += 4096 - freq.sum(axis=1)
        self.freq = freq.astype(np.uint64)
        start = np.concatenate([np.zeros((128, 1), np.uint64), np.cumsum(self.freq, axis=1)], axis=1)
        self.second, self.third = start[:, 1].copy(), start[:, 2].copy()
        # By 3 * row + choice.
        self.starts, self.freqs = start[:, :3].ravel(), self.freq.ravel()

    def learn(self, x, choice, two, one, row, h, b):
        for table, at, entry in ((self.follow2, h, two), (self.follow1, b, one)):
            conf, known = entry & 7, entry >> 3
            hit = known == x
            table[at] = np.where(hit, entry + (conf < 7), np.where(conf > 1, entry - conf + (conf >> 1), x << 3))
        got = np.bincount(row * 3 + choice, minlength=384).reshape(128, 3)
        weighed = self.weights[:, None, None] * self.parts
        share = (got * ((weighed << 12) // weighed.sum(axis=0))).sum(axis=(1, 2))
        self.weights = np.maximum(1, (3 * self.weights + (share << 12) // max(1, int(share.sum()))) // 4)
        self.seen += got * 2
        if self.seen.max() > 1 << 20:
            self.seen = (self.seen >> 1) + 1
        self._mix()
        literal = x[choice == 2]
        if len(literal):
            self.counts += np.bincount(literal, minlength=len(self.counts)) * 16
            if self.counts.sum() > 1 << 23:
                self.counts = (self.counts >> 1) + 1
            np.cumsum(self.counts, out=self.cum[1:])
            self.first = None

    def find(self, v):
        """Ids whose range of running counts holds v. Buckets of equal width know the id at their start; only a v whose bucket
        holds the start of another id is searched for."""
        if self.first is None:
            self.shift = max(0, int(self.cum[-1]).bit_length() - _BUCKETS.bit_length() + 1)
            begun = (self.cum + ((1 << self.shift) - 1)) >> self.shift
            self.first = np.cumsum(np.bincount(begun, minlength=_BUCKETS + 2)) - 1
        bucket = v >> self.shift
        y = self.first.take(bucket)
        more = np.flatnonzero(self.first.take(bucket + 1) > y)
        if len(more):
            y[more] = np.searchsorted(self.cum, v[more], side="right") - 1
        return y


def _learns(t: int) -> bool:
    """Whether the model learns after step t: often at first, then every eighth step."""
    return t & (t + 1) == 0 or t % 8 == 7


def _narrow(low, rng, start, freq, unit):
    low += unit * start
    rng[:] = unit * freq


def _shift(low, rng):
    """Lanes that must give up their leading 32 bits: either these are settled, or the range is cut at them."""
    small = np.flatnonzero(rng <= _LOW32)
    if len(small):
        lo, r = low[small], rng[small]
        open_ = ((lo ^ (lo + r - _U(1))) >> _S32) != 0
        r = np.where(open_, (_LOW32 - (lo & _LOW32)) + _U(1), r)
        low[small], rng[small] = lo << _S32, r << _S32
        top = lo >> _S32
        return small, top
    return small, None


def _lanes(n: int) -> tuple[int, int]:
    lanes = max(1, min(LANES, -(-n // 128)))
    return lanes, -(-n // lanes)


def encode(ids: np.ndarray) -> bytes:
    """A block: magic, crc32 of the rest, number of ids and of distinct values allowed, words of each lane, words."""
    n = len(ids)
    size = int(ids.max()) + 1 if n else 1
    lanes, steps = _lanes(n)
    grid = np.zeros(lanes * steps, np.int32)
    grid[:n] = ids
    grid = np.ascontiguousarray(grid.reshape(lanes, steps).T)
    model = _Model(size)
    low, rng = np.zeros(lanes, np.uint64), np.full(lanes, 2**64 - 1, np.uint64)
    out, pos = np.zeros((lanes, 2 * steps + 2), np.uint32), np.zeros(lanes, np.int64)

    def emit(small, top):
        if top is not None:
            out[small, pos[small]] = top
            pos[small] += 1

    t = 0
    while t < steps and n:
        z = t
        while not _learns(z) and z < steps - 1:
            z += 1
        x = grid[t:z + 1]
        b = grid[t - 1:z] if t else np.concatenate([np.zeros((1, lanes), np.int32), grid[:z]])
        a = grid[t - 2:z - 1] if t > 1 else np.concatenate([np.zeros((2, lanes), np.int32), grid[:z]])[t:z + 1]
        two, one, row, h = model.predict(np.ascontiguousarray(a), np.ascontiguousarray(b))
        choice = np.where(x == two >> 3, 0, np.where(x == one >> 3, 1, 2))
        at = row * 3 + choice
        start, freq = model.starts.take(at), model.freqs.take(at)
        literal = choice == 2
        s0 = np.where(literal, model.cum.take(x), 0).astype(np.uint64)
        f0, total = model.counts.take(x).astype(np.uint64), _U(int(model.cum[-1]))
        for i in range(z + 1 - t):
            _narrow(low, rng, start[i], freq[i], rng >> _S12)
            emit(*_shift(low, rng))
            unit = rng // total
            low += unit * s0[i]
            rng = np.where(literal[i], unit * f0[i], rng)
            emit(*_shift(low, rng))
        model.learn(x.ravel(), choice.ravel(), two.ravel(), one.ravel(), row.ravel(), h.ravel(), b.ravel())
        t = z + 1
    lane = np.arange(lanes)
    for word in (low >> _S32, low & _LOW32):
        out[lane, pos] = word
        pos += 1
    words = out[np.arange(out.shape[1]) < pos[:, None]]
    body = np.array([n, size], "<i8").tobytes() + pos.astype("<u4").tobytes() + words.astype("<u4").tobytes()
    return MAGIC + np.array([zlib.crc32(body)], "<u4").tobytes() + body


def decode(block: bytes) -> np.ndarray:
    """The ids of a block, as unsigned 32-bit; ValueError if its checksum does not hold."""
    body = block[8:]
    if block[:4] != MAGIC or len(block) < 24 or int.from_bytes(block[4:8], "little") != zlib.crc32(body):
        raise ValueError("damaged block")
    n, size = (int(v) for v in np.frombuffer(body, "<i8", 2))
    lanes, steps = _lanes(n)
    counts = np.frombuffer(body, "<u4", lanes, 16).astype(np.int64)
    words = np.append(np.frombuffer(body, "<u4", -1, 16 + 4 * lanes), 0).astype(np.uint64)
    at = np.cumsum(counts) - counts
    model = _Model(size)
    low, rng = np.zeros(lanes, np.uint64), np.full(lanes, 2**64 - 1, np.uint64)
    code = words[at] << _S32 | words[at + 1]
    at += 2
    grid = np.zeros((steps + 2, lanes), np.int32)

    def pull(small, top):
        if top is not None:
            code[small] = code[small] << _S32 | words[at[small]]
            at[small] += 1

    held: list = []
    for t in range(steps if n else 0):
        a, b = grid[t], grid[t + 1]
        two, one, row, h = model.predict(a, b)
        unit, ahead = rng >> _S12, code - low
        choice = (ahead >= unit * model.second.take(row)).view(np.int8) + (ahead >= unit * model.third.take(row))
        place = row * 3 + choice
        _narrow(low, rng, model.starts.take(place), model.freqs.take(place), unit)
        pull(*_shift(low, rng))
        x = np.where(choice == 0, two, one) >> 3
        lit = np.flatnonzero(choice == 2)
        if len(lit):
            total = _U(int(model.cum[-1]))
            lo = low[lit]
            unit = rng[lit] // total
            v = np.minimum((code[lit] - lo) // unit, total - _U(1)).astype(np.int64)
            y = model.find(v)
            x[lit] = y
            low[lit], rng[lit] = lo + unit * model.cum[y].astype(np.uint64), unit * model.counts[y].astype(np.uint64)
            pull(*_shift(low, rng))
        grid[t + 2] = x
        held.append((x, choice, two, one, row, h, b))
        if _learns(t):
            model.learn(*(np.concatenate(c) for c in zip(*held, strict=True)))
            held = []
    return grid[2:].T.ravel()[:n].astype(np.uint32)
