"""Words and shingles of many texts at once, as numpy arrays of 64-bit hashes.

A word is a run of bytes other than space and 0x09-0x0D; A-Z count as a-z.  Words
and shingles are compared by a 64-bit hash of their whole content.  Words of the
same length up to eight bytes never share one; two other words do with a chance
near 2**-64.
"""

from __future__ import annotations

import ctypes
import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_GAP = np.zeros(256, bool)
_GAP[[32, 9, 10, 11, 12, 13]] = True
_KEEP = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)  # the first k of eight bytes

#: Bytes of text handled in one numpy pass; a longer text has a pass of its own.
PASS_BYTES = 1 << 19
#: Bytes searched for words, and words hashed, in one step: bounds the temporary arrays of a long text.
STEP_BYTES = 1 << 19
STEP_WORDS = 1 << 16
#: Words of more bytes are hashed one by one.
LONG_WORD = 256


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of each 64-bit value over all of it."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _turns(buffer: np.ndarray) -> Iterator[np.ndarray]:
    inside = False
    for begin in range(0, len(buffer), STEP_BYTES):
        solid = ~_GAP[buffer[begin : begin + STEP_BYTES]]
        yield np.flatnonzero(np.diff(solid, prepend=inside)) + begin
        inside = bool(solid[-1])


def _edges(buffer: np.ndarray) -> np.ndarray:
    """Places where words start and end in turn; the buffer ends with a gap.  Those of a long text are counted before they are kept."""
    if len(buffer) <= STEP_BYTES:
        return np.flatnonzero(np.diff(~_GAP[buffer], prepend=False))
    edges = np.zeros(sum(map(len, _turns(buffer))), np.int64)
    upto = 0
    for turns in _turns(buffer):
        edges[upto : upto + len(turns)] = turns
        upto += len(turns)
    return edges


class Words:
    """The words of a list of texts: hash, start and end byte, and the first word of each text."""

    def __init__(self, texts: list[bytes]):
        self.buffer = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        self.text_start = np.concatenate(([0], np.cumsum(lengths + 1)))
        edges = _edges(self.buffer)
        self.start, self.end = edges[::2], edges[1::2]
        self.lower = np.zeros(len(self.buffer) + 8, np.uint8)  # eight bytes can be read from any place
        self.lower[:-8] = self.buffer
        self.lower += (self.lower - np.uint8(65) < 26).view(np.uint8) << np.uint8(5)
        self.hash = self.span_hash(self.start, self.end)
        self.first = np.searchsorted(self.start, self.text_start)

    def span_hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hash of the lower-cased bytes of each span."""
        value = np.zeros(len(start), np.uint64)
        for k in range(0, len(start), STEP_WORDS):
            value[k : k + STEP_WORDS] = self._hashes(start[k : k + STEP_WORDS], end[k : k + STEP_WORDS])
        return value

    def _hashes(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Eight bytes at a time are mixed into a value that begins with the length."""
        eight = np.ndarray(len(self.lower) - 7, "<u8", self.lower, strides=(1,))
        value = mix((end - start).astype(np.uint64))
        live = np.flatnonzero(end - start <= LONG_WORD)
        place, left = start[live], (end - start)[live]
        while len(live):
            value[live] = mix(value[live] ^ (eight[place] & _KEEP[np.minimum(left, 8)]))
            more = left > 8
            live, place, left = live[more], place[more] + 8, left[more] - 8
        for k in np.flatnonzero(end - start > LONG_WORD).tolist():
            digest = hashlib.blake2b(self.lower[start[k] : end[k]], digest_size=8).digest()
            value[k] ^= np.uint64(int.from_bytes(digest, "little"))
        return value

    def texts(self) -> Iterator[tuple[int, int, int]]:
        """Number, first word and end word of each text."""
        for k in range(len(self.first) - 1):
            yield k, int(self.first[k]), int(self.first[k + 1])


def shingles(words: np.ndarray, width: int) -> np.ndarray:
    """Hash of every run of ``width`` words (none if there are fewer)."""
    n = len(words) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for k in range(width):
        total += words[k : k + n] * np.uint64(pow(0xD6E8FEB86659FD93, k + 1, 1 << 64) | 1)
    return mix(total)


def hand_back() -> None:
    """Give freed memory back to the system: Python workers live on between tasks, beside the executor's heap."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim is not None:
        trim(0)


def passes(batches: Iterable[pa.RecordBatch], text: str = "text") -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Slices of Arrow batches with at most ``PASS_BYTES`` of text each, and their texts (null: empty)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        column = batch.column(text).cast(pa.binary())
        sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64) + 1
        begin = size = 0
        for k, n in enumerate(sizes.tolist()):
            if size and size + n > PASS_BYTES:
                yield batch.slice(begin, k - begin), [t or b"" for t in column.slice(begin, k - begin).to_pylist()]
                begin, size = k, 0
            size += n
        yield batch.slice(begin), [t or b"" for t in column.slice(begin).to_pylist()]
        del column, batch
        hand_back()
