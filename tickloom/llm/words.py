"""Words of many texts at once, as positions and 64-bit hashes in arrays."""

from __future__ import annotations

import numpy as np

from tickloom.llm.common import bounds, mixed

_STEP = 0x9E3779B97F4A7C15 | 1
_BACK = pow(_STEP, -1, 1 << 64)
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]

BLANK = np.zeros(256, bool)
BLANK[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def _grown(n: int) -> list[np.ndarray]:
    if len(_powers[0]) <= n:
        for k, step in enumerate((_STEP, _BACK)):
            factors = np.full(n + 2, step, np.uint64)
            factors[0] = 1
            _powers[k] = np.cumprod(factors, dtype=np.uint64)
    return _powers


def span_hashes(buffer: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of the bytes of each span; equal bytes, equal hash, wherever they lie."""
    up, down = _grown(len(buffer))
    sums = np.zeros(len(buffer) + 1, np.uint64)
    each = sums[1:]  # all in place: the arrays are eight times the text
    np.add(buffer, np.uint64(1), out=each)
    each *= up[: len(buffer)]
    np.cumsum(each, out=each)
    return mixed((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


class Words:
    """The words of ``texts``, one after the other: where they lie in ``buffer``, and ``at`` (words before each text)."""

    def __init__(self, texts: list[bytes], lower: bool = False):
        self.buffer = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
        if lower:
            self.buffer = LOWER[self.buffer]
        dark = np.concatenate([[False], ~BLANK[self.buffer]])
        edges = np.flatnonzero(dark[1:] != dark[:-1])
        self.starts, self.ends = edges[::2], edges[1::2]
        firsts = bounds(np.fromiter(map(len, texts), np.int64, len(texts)) + 1)
        self.at = np.searchsorted(self.starts, firsts)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.at)

    def hashes(self) -> np.ndarray:
        return span_hashes(self.buffer, self.starts, self.ends)

    def word(self, k: int) -> bytes:
        return self.buffer[self.starts[k] : self.ends[k]].tobytes()

    def some(self, places: np.ndarray) -> list[bytes]:
        """The words at these places."""
        raw = self.buffer.tobytes()
        return [raw[a:b] for a, b in zip(self.starts[places].tolist(), self.ends[places].tolist())]


class HashIndex:
    """Places of 64-bit hashes: an open-addressing table in arrays, looked up many at a time."""

    def __init__(self, bits: int = 16):
        self.bits, self.size = bits, 0
        self.keys, self.places = np.zeros(1 << bits, np.uint64), np.full(1 << bits, -1, np.int32)

    def __getstate__(self) -> np.ndarray:
        """The hashes in the order of their places; the table is built again from them."""
        used = self.places >= 0
        return self.keys[used][np.argsort(self.places[used])]

    def __setstate__(self, hashes: np.ndarray) -> None:
        self.__init__()
        self.add(hashes)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Place of each hash, -1 where it is unknown."""
        out = np.full(len(hashes), -1, np.int32)
        left, slot = np.arange(len(hashes)), (hashes >> np.uint64(64 - self.bits)).astype(np.int64)
        while len(left):
            place = self.places[slot]
            hit = self.keys[slot] == hashes[left]
            out[left[hit]] = place[hit]
            go = ~hit & (place >= 0)
            left, slot = left[go], (slot[go] + 1) & ((1 << self.bits) - 1)
        return out

    def add(self, hashes: np.ndarray) -> None:
        """Number distinct unknown hashes from ``size`` on."""
        while (self.size + len(hashes)) * 2 > len(self.keys):
            old, order = self.keys[self.places >= 0], np.argsort(self.places[self.places >= 0])
            self.bits += 1
            self.keys, self.places, self.size = np.zeros(1 << self.bits, np.uint64), np.full(1 << self.bits, -1, np.int32), 0
            self._put(old[order])
        self._put(hashes)

    def _put(self, hashes: np.ndarray) -> None:
        left, slot = np.arange(len(hashes)), (hashes >> np.uint64(64 - self.bits)).astype(np.int64)
        while len(left):
            free = self.places[slot] < 0
            self.places[slot[free]] = left[free] + self.size  # of several for a slot the last one stays
            self.keys[slot[free]] = hashes[left[free]]
            go = self.places[slot] != left + self.size
            left, slot = left[go], (slot[go] + 1) & ((1 << self.bits) - 1)
        self.size += len(hashes)
