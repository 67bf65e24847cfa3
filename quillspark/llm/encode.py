"""Token ids of whole Arrow batches.

A byte-level BPE applies its merges inside pre-tokens, so a text may be cut
at any pre-token boundary without changing its ids. Texts are cut before
single spaces and around newlines that are certainly such boundaries; every
distinct piece is encoded once by ``tokenizers`` and the ids of a batch are
gathered from that pool, so repeated words cost a look-up.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from . import textscan as ts

SLICE_BYTES = 6 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E), *range(0x1C, 0x20)]] = True
# Lead bytes of the characters that include Unicode white space, and all continuation bytes.
_UNSURE = np.zeros(256, bool)
_UNSURE[[0xC2, 0xE1, 0xE2, 0xE3, *range(0x80, 0xC0)]] = True
# A letter before one of these marks ends a pre-token (no special string holds them).
_LETTER, _STOP = np.zeros(256, bool), np.zeros(256, bool)
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
_STOP[[ord(c) for c in ",.;:!?"]] = True
POOL_ENTRIES = 800_000         # the pool starts anew beyond this many pieces

_LEARN = 20_000                # pieces given to the tokenizer at once

_ENCODERS: dict = {}


def encoder(path: str, plain_specials: bool) -> "Encoder":
    """One encoder per worker process, file and treatment of special strings."""
    key = (path, plain_specials)
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(path, plain_specials)
    return _ENCODERS[key]


class Encoder:
    def __init__(self, path: str, plain_specials: bool = False):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # True: strings such as an end marker are ordinary text.
        self.tokenizer.encode_special_tokens = plain_specials
        self._batch = getattr(self.tokenizer, "encode_batch_fast", self.tokenizer.encode_batch)
        self._clear()

    def _clear(self) -> None:
        self.keys = np.zeros(0, np.uint64)      # sorted piece hashes
        self.at = np.zeros(0, np.int64)         # their place in the pool
        self.size = np.zeros(0, np.int64)
        self.pool = np.zeros(0, np.uint32)

    def _pieces(self, texts: pa.Array) -> ts.Units:
        data, offs = ts._bytes(texts)
        n = len(data) - 8
        b, nxt = data[:n], data[1:n + 1]
        cuts = np.zeros(n + 1, bool)
        if n:
            space, inner = _SPACE[b], np.ones(n, bool)
            inner[offs[1:][offs[1:] > 0] - 1] = False              # last byte of a document
            solid_next = ~(_SPACE | _UNSURE)[nxt] & inner
            cuts[:n] = (b == 0x20) & solid_next
            line = (b == 0x0A) & solid_next
            line[1:] &= ~space[:-1] & (b[:-1] < 0x80)
            line[:1] = False
            cuts[:n] |= line
            cuts[1:] |= line
            cuts[1:n] |= _LETTER[b[:-1]] & _STOP[b[1:]]
        cuts[offs] = True
        edge = np.flatnonzero(cuts)
        start, end = edge[:-1], edge[1:]
        return ts.Units(data, start, end, np.searchsorted(start, offs))

    def _learn(self, keys: np.ndarray, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> None:
        view = data.tobytes()
        sizes, flats = [], []
        for lo in range(0, len(start), _LEARN):         # bounds the encoder's own objects
            spans = zip(start[lo:lo + _LEARN].tolist(), end[lo:lo + _LEARN].tolist())
            ids = [e.ids for e in self._batch([view[s:e].decode("utf-8") for s, e in spans], add_special_tokens=False)]
            sizes.append(np.fromiter(map(len, ids), np.int64, len(ids)))
            flats.append(np.fromiter((x for row in ids for x in row), np.uint32, int(sizes[-1].sum())))
        size, flat = np.concatenate(sizes), np.concatenate(flats)
        at = len(self.pool) + np.concatenate([[0], np.cumsum(size)[:-1]]).astype(np.int64)
        self.pool = np.concatenate([self.pool, flat])
        place = np.searchsorted(self.keys, keys)        # both sorted
        self.keys = np.insert(self.keys, place, keys)
        self.at = np.insert(self.at, place, at)
        self.size = np.insert(self.size, place, size)

    def ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of all texts and the first position of each (n + 1 values)."""
        u = self._pieces(texts)
        if not len(u.start):
            return np.zeros(0, np.uint32), np.zeros(len(texts) + 1, np.int64)
        h = u.hashes()
        uniq, first, inverse = np.unique(h, return_index=True, return_inverse=True)
        if len(self.keys) + len(uniq) > POOL_ENTRIES:
            self._clear()
        pos = np.minimum(np.searchsorted(self.keys, uniq), max(len(self.keys) - 1, 0))
        new = self.keys[pos] != uniq if len(self.keys) else np.ones(len(uniq), bool)
        if new.any():
            self._learn(uniq[new], u.data, u.start[first[new]], u.end[first[new]])
            pos = np.searchsorted(self.keys, uniq)
        at, size = self.at[pos][inverse], self.size[pos][inverse]
        stop = np.cumsum(size)
        flat = self.pool[np.repeat(at - (stop - size), size) + np.arange(int(stop[-1]))]
        return flat, np.concatenate([[0], stop])[u.first]
