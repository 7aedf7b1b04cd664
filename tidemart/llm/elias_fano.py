"""Monotone sequences in Elias-Fano form, searched many values at a time.

The low bytes of each value are stored as they are; the high parts as unary gaps
in a bit vector with a count of ones per 64 bits.  All arrays of a structure lie
in one memory map.
"""

from __future__ import annotations

import mmap

import numpy as np

CHUNK = 1 << 17


class Arena:
    """Arrays in one anonymous memory map of a known size."""

    def __init__(self, size: int):
        self._map = mmap.mmap(-1, max(size, 1))
        self._at = 0

    def put(self, array: np.ndarray) -> np.ndarray:
        raw = np.ascontiguousarray(array)
        view = np.frombuffer(self._map, raw.dtype, raw.size, self._at).reshape(raw.shape)
        view[...] = raw
        self._at += -(-raw.nbytes // 8) * 8
        return view


class Bits:
    """A bit vector with select of ones and zeros."""

    def __init__(self, set_bits: np.ndarray, length: int):
        flags = np.zeros(-(-(length + 1) // 64) * 64, bool)
        flags[set_bits] = True
        self.bits = np.packbits(flags, bitorder="little").view("<u8")
        per_word = np.bitwise_count(self.bits).astype(np.int64)
        self.ones = np.concatenate(([0], np.cumsum(per_word)[:-1])).astype(np.uint32)

    def select(self, rank: np.ndarray, bit: int) -> np.ndarray:
        """Place of the ``rank``-th (from 0) bit of that kind."""
        out = np.zeros(len(rank), np.int64)
        starts = self.ones.astype(np.int64)
        if not bit:
            starts = np.arange(len(starts)) * 64 - starts
        for at in range(0, len(rank), CHUNK):
            want = rank[at : at + CHUNK]
            word = np.searchsorted(starts, want, side="right") - 1
            rest = (want - starts[word]).astype(np.uint8)
            bits = self.bits[word]
            if not bit:
                bits = ~bits
            place = word * 64
            for half in (32, 16, 8, 4, 2, 1):  # skip the lower half if the bit lies above it
                below = np.bitwise_count(bits & np.uint64((1 << half) - 1))
                above = rest >= below
                rest -= below * above
                skip = above * np.uint8(half)
                bits >>= skip
                place += skip
            out[at : at + CHUNK] = place
        return out


class EliasFano:
    """A sorted array of unsigned 64-bit values below 2**``top``."""

    def __init__(self, values: np.ndarray, top: int):
        self.n = len(values)
        spare = max(0, top - max(self.n, 1).bit_length())
        self.low_bytes = min(-(-spare // 8), 7)
        values = values.astype("<u8")
        self.low = values.view(np.uint8).reshape(-1, 8)[:, : self.low_bytes].copy()
        high = (values >> np.uint64(8 * self.low_bytes)).astype(np.int64)
        self.buckets = int(high[-1]) + 1 if self.n else 0
        self.high = Bits(high + np.arange(self.n), self.n + self.buckets)

    def nbytes(self) -> int:
        return sum(-(-a.nbytes // 8) * 8 for a in (self.low, self.high.bits, self.high.ones))

    def move(self, arena: Arena) -> EliasFano:
        self.low, self.high.bits, self.high.ones = (arena.put(a) for a in (self.low, self.high.bits, self.high.ones))
        return self

    def _low(self, at: np.ndarray) -> np.ndarray:
        wide = np.zeros((len(at), 8), np.uint8)
        wide[:, : self.low_bytes] = self.low[at]
        return wide.view("<u8").ravel()

    def access(self, at: np.ndarray) -> np.ndarray:
        """Values at the places ``at``."""
        high = self.high.select(at, 1) - at
        return (high.astype(np.uint64) << np.uint64(8 * self.low_bytes)) | self._low(at)

    def successor(self, value: np.ndarray, begin: np.ndarray | None = None, end: np.ndarray | None = None) -> np.ndarray:
        """Place of the first value that is not smaller, within [begin, end) if given (``end`` if there is none)."""
        value = value.astype(np.uint64)
        shift = np.uint64(8 * self.low_bytes)
        bucket = (value >> shift).astype(np.int64)
        inside = bucket < self.buckets
        lo, hi = np.full(len(value), self.n, np.int64), np.full(len(value), self.n, np.int64)
        b = bucket[inside]
        lo[inside] = np.where(b > 0, self.high.select(np.maximum(b - 1, 0), 0) - (b - 1), 0)
        hi[inside] = self.high.select(b, 0) - b
        lo = np.maximum(lo, 0)
        if begin is not None:
            lo, hi = np.clip(lo, begin, end), np.clip(hi, begin, end)
        want = value & ((np.uint64(1) << shift) - np.uint64(1))
        while True:
            open_ = np.flatnonzero(lo < hi)
            if not len(open_):
                return lo
            middle = (lo[open_] + hi[open_]) // 2
            less = self._low(middle) < want[open_]
            lo[open_[less]] = middle[less] + 1
            hi[open_[~less]] = middle[~less]
