"""Vectorised scanning of Arrow string arrays inside Python tasks.

Texts are cut into units (words or lines) with one table look-up per byte and
each unit gets a 64-bit hash of its bytes, without a Python object per unit.
All separators are ASCII, so cutting UTF-8 bytes never splits a character.
Work is done in slices of a few megabytes of whole documents, which bounds a
task's memory whatever the batch size; one very long document is a slice.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

# A worker lives through many tasks: freed Arrow buffers go back to the
# allocator, and after each batch the allocator's free pages to the system.
pa.set_memory_pool(pa.system_memory_pool())
_trim = getattr(ctypes.CDLL(None), "malloc_trim", None)

SLICE_BYTES = 3 << 20
_LONG = 64                     # units beyond this many bytes are hashed one by one

WORD_SEPARATORS = np.zeros(256, dtype=bool)
WORD_SEPARATORS[[0x20, *range(0x09, 0x0E)]] = True
LINE_SEPARATORS = np.zeros(256, dtype=bool)
LINE_SEPARATORS[0x0A] = True

_K1 = np.uint64(0x9E3779B97F4A7C15)
_K2 = np.uint64(0xBF58476D1CE4E5B9)
_K3 = np.uint64(0x94D049BB133111EB)
_LOW = np.array([(1 << (8 * k)) - 1 for k in range(8)] + [2**64 - 1], dtype=np.uint64)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (works on a copy)."""
    h = h ^ (h >> np.uint64(30))
    h *= _K2
    h ^= h >> np.uint64(27)
    h *= _K3
    h ^= h >> np.uint64(31)
    return h


@dataclass
class Units:
    """Units of some documents: byte spans into ``data`` in document order.

    ``first[i] : first[i + 1]`` are the units of document ``i``; ``data`` ends
    with eight bytes of padding.
    """

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    def hashes(self) -> np.ndarray:
        return hash_spans(self.data, self.start, self.end)

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def owners(self) -> np.ndarray:
        """Document number of each unit."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts())


def hash_spans(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of ``data[start:end]`` for each span, eight bytes a step."""
    size = end - start
    h = size.astype(np.uint64) * _K1
    if not len(start):
        return h
    eight = np.ndarray(shape=(max(len(data) - 7, 0),), dtype="<u8", buffer=data, strides=(1,))
    live = np.flatnonzero(size <= _LONG)
    at, left = start[live], size[live]
    while len(live):
        part = eight[at] & _LOW[np.minimum(left, 8)]
        h[live] = mix((h[live] ^ part) + _K1)
        more = left > 8
        live, at, left = live[more], at[more] + 8, left[more] - 8
    view = memoryview(data)
    for i in np.flatnonzero(size > _LONG):
        h[i] = xxhash.xxh3_64_intdigest(view[start[i]:end[i]])
    return h


def _bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Padded bytes and offsets of a null-free large_string array."""
    n = len(texts)
    if n == 0:
        return np.zeros(8, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = texts.buffers()
    offs = np.frombuffer(offsets, dtype=np.int64, count=n + 1, offset=8 * texts.offset)
    lo, hi = int(offs[0]), int(offs[-1])
    out = np.zeros(hi - lo + 8, dtype=np.uint8)
    if hi > lo:
        out[: hi - lo] = np.frombuffer(data, dtype=np.uint8, count=hi - lo, offset=lo)
    return out, offs - lo


def plain(texts: pa.Array | pa.ChunkedArray) -> pa.Array:
    """As one large_string array without nulls (null becomes empty)."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string())
    return pc.fill_null(texts, "") if texts.null_count else texts


def cut(texts: pa.Array, separators: np.ndarray = WORD_SEPARATORS) -> Units:
    """Maximal runs of non-separator bytes of each text."""
    data, offs = _bytes(texts)
    size = len(data) - 8
    gap = np.empty(size + 1, dtype=bool)
    np.take(separators, data[:size], out=gap[:size])
    gap[size] = True
    begin = np.zeros(size + 1, dtype=bool)          # a document starts here
    begin[offs] = True
    opens = ~gap[:size]
    opens[1:] &= gap[: max(size - 1, 0)] | begin[1:size]
    closes = ~gap[:size] & (gap[1:] | begin[1:])
    start, end = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    return Units(data, start, end, np.searchsorted(start, offs))


def cut_lines(texts: pa.Array) -> Units:
    """Lines of each text (split at newline) that hold a word; others are left out."""
    lines = cut(texts, LINE_SEPARATORS)
    words = cut(texts, WORD_SEPARATORS)
    has = np.searchsorted(words.start, lines.end) > np.searchsorted(words.start, lines.start)
    kept = np.concatenate([[0], np.cumsum(has)])
    return Units(lines.data, lines.start[has], lines.end[has], kept[lines.first])


def slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of documents of about ``limit`` bytes, at least one document each."""
    n = len(texts)
    if n == 0:
        return
    offs = np.frombuffer(texts.buffers()[1], dtype=np.int64, count=n + 1, offset=8 * texts.offset)
    lo = 0
    while lo < n:
        hi = int(np.searchsorted(offs, offs[lo] + limit, side="right")) - 1
        hi = min(max(hi, lo + 1), n)
        yield lo, hi
        lo = hi
    if _trim is not None:
        _trim(0)


def ngrams(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of ``k`` consecutive unit hashes (may cross documents)."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(n, np.uint64)
    factor = 1
    for j in range(k):
        total += h[j:j + n] * np.uint64(factor)
        factor = factor * 0x9E3779B97F4A7C15 % 2**64
    return mix(total)


def inside(units: Units, k: int) -> np.ndarray:
    """Whether the run of ``k`` units from each unit stays in its document."""
    n = len(units.start) - k + 1
    if n <= 0:
        return np.zeros(0, bool)
    last = np.repeat(units.first[1:], units.counts())[:n]
    return np.arange(n) + k <= last


def sliding_min(a: np.ndarray, w: int) -> np.ndarray:
    """Minimum of each ``w`` consecutive values, by doubling."""
    have = 1
    while have * 2 <= w:
        a = np.minimum(a[:-have], a[have:]) if len(a) > have else a[:0]
        have *= 2
    if have < w:
        d = w - have
        a = np.minimum(a[:-d], a[d:]) if len(a) > d else a[:0]
    return a
