"""Cutting texts where no token can span, and remembering what a piece gives.

Byte-level vocabularies cut a text into words before merging. Some cuts can be told from neighbouring bytes alone: a
single space between solid characters begins a word, a single line feed between solid characters is a word, and ASCII
punctuation after an ASCII letter or digit begins one. Cutting there, on whole batches at once, gives pieces that repeat
across texts; each distinct piece is worked out once and looked up by its 64-bit fingerprint. A piece that is found is
compared byte by byte with the one that was remembered; pieces over ``LONG_BYTES`` are not remembered.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

from .batches import LONG_BYTES, fingerprints, same_bytes

SLOTS = 1 << 20
POOL_ITEMS = 1 << 23

_SOLID = np.ones(256, bool)
_SOLID[[*range(9, 14), *range(28, 33)]] = False
_ALNUM = np.zeros(256, bool)
_ALNUM[[*range(48, 58), *range(65, 91), *range(97, 123)]] = True
_PUNCT = np.zeros(256, bool)
_PUNCT[33:127] = ~_ALNUM[33:127]


def cut(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and size of every piece; pieces are contiguous and end with their row."""
    n = len(data)
    solid = _SOLID[data]
    if (data >= 0x80).any():  # what may be a non-ASCII space is not solid
        a, b = data[:-1], data[1:]
        for first, second in ((0xC2, (0x85, 0xA0)), (0xE1, (0x9A,)), (0xE2, (0x80, 0x81)), (0xE3, (0x80,))):
            at = np.flatnonzero((a == first) & np.isin(b, second))
            for k in range(3 if first > 0xC2 else 2):
                solid[np.minimum(at + k, n - 1)] = False
    row_starts = offsets[:-1][np.diff(offsets) > 0]
    before, after, letter = np.empty(n, bool), np.empty(n, bool), np.empty(n, bool)
    before[0], before[1:] = False, solid[:-1]
    after[-1], after[:-1] = False, solid[1:]
    letter[0], letter[1:] = False, _ALNUM[data[:-1]]
    before[row_starts] = False
    after[row_starts[row_starts > 0] - 1] = False
    between = before & after
    start = (data == 32) & between
    line = np.flatnonzero((data == 10) & between)
    start[line] = True
    start[line + 1] = True
    start |= _PUNCT[data] & letter
    start[row_starts] = True
    starts = np.flatnonzero(start)
    ends = np.append(starts[1:], n)
    return starts, ends - starts


class PieceMemory:
    """A direct-mapped cache of bounded size from pieces to arrays of 32-bit numbers, that ``make(texts)`` works out: the
    numbers of all texts one after another, and how many each has."""

    def __init__(self, make: Callable[[list[str]], tuple[np.ndarray, np.ndarray]]):
        self.make = make
        self._reset()

    def _reset(self) -> None:
        self.keys, self.held = np.zeros(SLOTS, np.uint64), np.zeros((SLOTS, LONG_BYTES), np.uint8)
        self.at, self.size, self.length = (np.zeros(SLOTS, np.int32) for _ in range(3))
        self.pool, self.used = np.zeros(POOL_ITEMS, np.uint32), 0

    def _known(self, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray, h: np.ndarray, slot: np.ndarray) -> np.ndarray:
        """Which pieces are remembered, with the very same bytes."""
        known = (self.keys[slot] == h) & (self.length[slot] == sizes)
        at = np.flatnonzero(known)
        known[at] = same_bytes(data, starts[at], self.held.reshape(-1), slot[at] * LONG_BYTES, sizes[at])
        return known

    def _made(self, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray, h: np.ndarray):
        """Numbers of the distinct ones of some pieces, the count of each, where each begins, and which piece is which: pieces are
        the same if their bytes are. Also the first piece of each."""
        _, first, which = np.unique(h, return_index=True, return_inverse=True)
        same = sizes == sizes[first[which]]
        at = np.flatnonzero(same)
        same[at] = same_bytes(data, starts[at], data, starts[first[which[at]]], sizes[at])
        odd = np.flatnonzero(~same)  # share a fingerprint with another piece: each stands for itself
        which[odd] = len(first) + np.arange(len(odd))
        first = np.concatenate([first, odd])
        raw = data.tobytes()
        flat, count = self.make([raw[i:i + n].decode() for i, n in zip(starts[first].tolist(), sizes[first].tolist())])
        return flat, count, np.cumsum(count) - count, which, first

    def rows(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The numbers of all rows, one after another, and the n + 1 places where rows begin."""
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
        starts, sizes = cut(data, offsets)
        h = fingerprints(data, starts, sizes)
        slot = (h & np.uint64(SLOTS - 1)).astype(np.int64)
        at, size = self.at[slot].astype(np.int64), self.size[slot].astype(np.int64)
        missing = np.flatnonzero(~self._known(data, starts, sizes, h, slot))
        pool = self.pool
        if len(missing):
            flat, count, places, which, first = self._made(data, starts[missing], sizes[missing], h[missing])
            if self.used + len(flat) > POOL_ITEMS:
                pool = np.concatenate([self.pool[:self.used], flat])  # what was found above stays valid for this call
                at[missing], size[missing] = self.used + places[which], count[which]
                self._reset()
            else:
                self.pool[self.used:self.used + len(flat)] = flat
                places += self.used
                self.used += len(flat)
                at[missing], size[missing] = places[which], count[which]
                self._remember(data, starts, sizes, h, slot, missing[first], places, count)
        done = np.concatenate([[0], np.cumsum(size)])
        out = pool[np.repeat(at - done[:-1], size) + np.arange(done[-1])]
        return out, done[np.searchsorted(starts, offsets)]

    def _remember(self, data, starts, sizes, h, slot, pieces, places, count) -> None:
        short = sizes[pieces] <= LONG_BYTES
        pieces, places, count = pieces[short], places[short], count[short]
        _, last = np.unique(slot[pieces][::-1], return_index=True)  # of pieces that share a slot, one
        use = len(pieces) - 1 - last
        pieces, into = pieces[use], slot[pieces[use]]
        self.keys[into], self.length[into] = h[pieces], sizes[pieces]
        self.at[into], self.size[into] = places[use], count[use]
        padded = np.concatenate([data, np.zeros(LONG_BYTES, np.uint8)])
        self.held[into] = padded[starts[pieces][:, None] + np.arange(LONG_BYTES)]
