"""Encoding of many texts through their different words, each encoded once."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable

import numpy as np
import pyarrow as pa

from .common import Words, steps

#: Bytes of text encoded together: the more, the more often a word repeats.
STEP = 1 << 20


def per_process(name: str, make: Callable):
    """What make() gives, made once in a Python worker, which serves many tasks."""
    kept = sys.modules.setdefault("tidepool_worker_state", types.ModuleType("tidepool_worker_state")).__dict__
    if name not in kept:
        kept[name] = make()
    return kept[name]


def spread(at: np.ndarray, start: np.ndarray, size: np.ndarray, flat: np.ndarray) -> np.ndarray:
    """flat[start[i] : start[i] + size[i]] for all i of `at`, one after the other."""
    n = size[at]
    total = int(n.sum())
    if not total:
        return flat[:0]
    shift = np.repeat(start[at] - (np.cumsum(n) - n), n)
    return flat[shift + np.arange(total)]


class Memo:
    """Ids of words, learnt by encode(bytes, starts, ends) -> (ids of all, how many each has).

    Words are found by their 64-bit hash in a sorted array and then compared
    byte by byte. Beyond `limit` words, those met only once since the last such
    time are dropped (of too many others, the less frequent), so frequent words
    are encoded once a worker.
    """

    def __init__(self, encode: Callable[[bytes, np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]], blanks: bytes = b" \t\n\x0b\x0c\r", limit: int = 300_000):
        self.encode, self.blanks, self.limit = encode, blanks, limit
        none = np.zeros(0, np.int64)
        self.hash, self.entry = np.zeros(0, np.uint64), none  # sorted hashes, and where each word is held
        self.start, self.size, self.flat = none, none, np.zeros(0, np.uint32)
        self.word, self.length, self.bytes = none, none, np.zeros(0, np.uint8)
        self.uses = none

    def _drop(self) -> None:
        """Keep the words met more than once, at most half the limit."""
        least = 2
        if (self.uses >= least).sum() > self.limit // 2:
            least = max(least, int(np.partition(self.uses, -(self.limit // 2))[-(self.limit // 2)]) + 1)
        keep = np.flatnonzero(self.uses >= least)
        place = np.full(len(self.uses), -1, dtype=np.int64)
        place[keep] = np.arange(len(keep))
        stays = place[self.entry] >= 0
        self.hash, self.entry = self.hash[stays], place[self.entry[stays]]
        for starts, sizes, flat in (("start", "size", "flat"), ("word", "length", "bytes")):
            n = getattr(self, sizes)[keep]
            setattr(self, flat, spread(keep, getattr(self, starts), getattr(self, sizes), getattr(self, flat)))
            setattr(self, starts, np.cumsum(n) - n)
            setattr(self, sizes, n)
        self.uses = np.ones(len(keep), dtype=np.int64)

    def _find(self, hashes: np.ndarray, starts: np.ndarray, ends: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(entry or -1 of each word, place of its hash): an entry has the word's hash, length and bytes."""
        place = np.searchsorted(self.hash, hashes)
        found = np.full(len(hashes), -1, dtype=np.int64)
        if not len(self.hash):
            return found, place
        near = np.minimum(place, len(self.hash) - 1)
        entry = self.entry[near]
        at = np.flatnonzero((self.hash[near] == hashes) & (self.length[entry] == ends - starts))
        size = (ends - starts)[at]
        differ = spread(at, starts, ends - starts, data) != spread(entry[at], self.word, self.length, self.bytes)
        if differ.any():
            at = at[np.add.reduceat(differ.astype(np.int64), np.cumsum(size) - size) == 0]
        found[at] = entry[at]
        return found, place

    def _step(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if len(self.size) > self.limit:
            self._drop()
        words = Words(data, offsets, self.blanks)
        hashes, first, which, times = np.unique(words.hash, return_index=True, return_inverse=True, return_counts=True)
        starts, ends = words.starts[first], words.ends[first]
        at, place = self._find(hashes, starts, ends, data)
        self.uses[at[at >= 0]] += times[at >= 0]
        new = np.flatnonzero(at < 0)
        if len(new):
            ids, size = self.encode(data.tobytes(), starts[new], ends[new])
            at[new] = len(self.size) + np.arange(len(new))
            length = (ends - starts)[new]
            self.start = np.concatenate((self.start, len(self.flat) + np.cumsum(size) - size))
            self.word = np.concatenate((self.word, len(self.bytes) + np.cumsum(length) - length))
            self.bytes = np.concatenate((self.bytes, spread(new, starts, ends - starts, data)))
            self.size, self.flat = np.concatenate((self.size, size)), np.concatenate((self.flat, ids.astype(np.uint32)))
            self.length, self.uses = np.concatenate((self.length, length)), np.concatenate((self.uses, times[new]))
            # another word of the same hash keeps its place; this one is encoded whenever it comes
            free = new if not len(self.hash) else new[self.hash[np.minimum(place[new], len(self.hash) - 1)] != hashes[new]]
            self.entry = np.insert(self.entry, place[free], at[free])
            self.hash = np.insert(self.hash, place[free], hashes[free])
        at = at[which]
        run = np.concatenate(([0], np.cumsum(self.size[at])))
        return spread(at, self.start, self.size, self.flat), run[words.first[1:]] - run[words.first[:-1]]

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of all texts and how many each text has."""
        found = [self._step(data, offsets) for _, _, data, offsets in steps(texts, STEP)]
        return np.concatenate([np.zeros(0, np.uint32), *(f[0] for f in found)]), np.concatenate([np.zeros(0, np.int64), *(f[1] for f in found)])


def decoded(data: bytes, starts: np.ndarray, ends: np.ndarray) -> list[str]:
    """The words as strings."""
    return [data[a:b].decode() for a, b in zip(starts.tolist(), ends.tolist())]
