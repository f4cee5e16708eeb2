"""Words of whole Arrow batches as numpy arrays, for use inside Spark tasks.

A word is a longest run of bytes other than 0x20 and 0x09-0x0D, which in UTF-8 is the same as
``[^\\x20\\x09-\\x0D]+``. Nothing here keeps more than one slice of about ``SLICE_BYTES`` of text (or one
longer text) at a time. Words and word sequences are identified by 64-bit hashes.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES, SLICE_ROWS = 500_000, 50_000
SHINGLE = 5

_BASE = 0x9E3779B97F4A7C55  # odd, so that it has an inverse modulo 2**64
_STEP = np.uint64(0xD6E8FEB86659FD93)
_powers = np.ones(1, np.uint64)
_inverses = np.ones(1, np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit numbers that spreads every bit."""
    x = np.asarray(x, np.uint64).copy()
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _table(base: int, size: int) -> np.ndarray:
    steps = np.full(size, base, np.uint64)
    steps[0] = 1
    return np.cumprod(steps, dtype=np.uint64)


def _power_tables(size: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers, _inverses
    if len(_powers) < size:
        size = max(size, SLICE_BYTES + 1, len(_powers) * 3 // 2)
        _powers, _inverses = _table(_BASE, size), _table(pow(_BASE, -1, 2**64), size)
    return _powers, _inverses


Batches = Iterator[pa.RecordBatch]


def released(task: Callable[[Batches], Batches]) -> Callable[[Batches], Batches]:
    """The task, after which its worker gives its memory back: workers live on idle while other stages run."""

    def run(batches: Batches) -> Batches:
        global _powers, _inverses
        try:
            yield from task(batches)
        finally:
            _powers, _inverses = np.ones(1, np.uint64), np.ones(1, np.uint64)
            pa.default_memory_pool().release_unused()
            try:
                ctypes.CDLL(None).malloc_trim(0)
            except (OSError, AttributeError):  # another C library
                pass

    return run


def slices(texts: pa.Array, most: int = SLICE_BYTES, sizes: pa.Array | None = None) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``most`` bytes of text and ``SLICE_ROWS`` rows, or of one row; ``sizes`` where texts are compressed."""
    size = np.asarray(pc.fill_null(pc.binary_length(texts) if sizes is None else sizes, 0))
    first, total = 0, 0
    for i, n in enumerate(size.tolist()):
        if i > first and (total + n > most or i - first >= SLICE_ROWS):
            yield first, i
            first, total = i, 0
        total += n
    if first < len(size):
        yield first, len(size)


class Words:
    """The words of some texts: for each its text's number, its place in the bytes and its hash."""

    def __init__(self, texts: pa.Array, lower: bool = True):
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        n = len(texts)
        _, offsets, data = texts.buffers()
        offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + n + 1] if n else np.zeros(1, np.int64)
        raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None and data.size else np.zeros(0, np.uint8)
        self.n, self.offsets, self.raw = n, offsets - offsets[0], raw
        self.data = raw + ((raw >= 65) & (raw <= 90)) * np.uint8(32) if lower else raw
        self.solid = ~((raw == 32) | ((raw >= 9) & (raw <= 13)))
        edge = np.zeros(len(raw) + 1, bool)
        edge[self.offsets] = True
        before, after = np.zeros(len(raw), bool), np.zeros(len(raw), bool)
        before[1:], after[:-1] = self.solid[:-1], self.solid[1:]
        self.start = np.flatnonzero(self.solid & (~before | edge[:-1]))
        self.end = np.flatnonzero(self.solid & (~after | edge[1:])) + 1
        self.doc = np.searchsorted(self.offsets[1:], self.start, side="right")
        self.count = np.bincount(self.doc, minlength=n)
        self.first = np.concatenate([[0], np.cumsum(self.count)])
        powers, self._inverse = _power_tables(len(raw) + 1)
        self._sums = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum((self.data.astype(np.uint64) + np.uint64(1)) * powers[: len(raw)], out=self._sums[1:])
        self.hash = self.span_hash(self.start, self.end)

    def span_hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """A hash of each byte range's content."""
        return mix((self._sums[end] - self._sums[start]) * self._inverse[start] + (end - start).astype(np.uint64) * _STEP)

    def per_text(self, flags: np.ndarray) -> np.ndarray:
        """The sum over each text's bytes."""
        sums = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
        return sums[self.offsets[1:]] - sums[self.offsets[:-1]]

    def windows(self, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
        """First word and hash of each run of ``size`` words that lies within one text."""
        n = len(self.hash) - size + 1
        if n <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        at = np.flatnonzero(self.doc[:n] == self.doc[size - 1 :])
        out = np.full(len(at), size, np.uint64)
        for i in range(size):
            out = mix(out * _STEP + self.hash[at + i])
        return at, out

    def shingle_sets(self, size: int = SHINGLE) -> list[np.ndarray]:
        """Each text's sorted distinct shingles; a text with fewer words has its whole sequence as one."""
        at, hashes = self.windows(size)
        ends = np.searchsorted(self.doc[at], np.arange(self.n + 1))
        out = []
        for i in range(self.n):
            if 0 < self.count[i] < size:
                one = np.full(1, self.count[i], np.uint64)
                for h in self.hash[self.first[i] : self.first[i + 1]]:
                    one = mix(one * _STEP + h)
                out.append(one)
            else:
                out.append(np.unique(hashes[ends[i] : ends[i + 1]]))
        return out


def signed(x: np.ndarray) -> np.ndarray:
    """Unsigned 64-bit numbers as Spark's long."""
    return np.ascontiguousarray(x, np.uint64).view(np.int64)
