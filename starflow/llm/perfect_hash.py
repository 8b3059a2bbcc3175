"""Minimal perfect hashing of 64-bit keys, by levels of bitmaps.

A key that is alone on its bit of level 0 is settled there; keys that collide try level 1,
and so on. The rank of a key's bit over all levels is its slot, so n keys get the slots
0..n-1. Building and looking up are whole-array operations; a look-up visits 1.6 levels on
average, whatever n is.
"""

from __future__ import annotations

import numpy as np

_GAMMA = 2  # bits per key on a level
_MOST_LEVELS = 48
_STEP = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)


def _places(keys: np.ndarray, level: int, bits: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = keys + _STEP * np.uint64(level + 1)
        x = (x ^ (x >> np.uint64(30))) * _MIX
        x = x ^ (x >> np.uint64(27))
    return (x % np.uint64(bits)).astype(np.int64)


class PerfectHash:
    """``levels`` are bool arrays; ``rest`` are the keys that no level could settle."""

    def __init__(self, levels: list[np.ndarray], rest: np.ndarray):
        self.levels, self.rest = levels, rest
        counts = [int(bits.sum()) for bits in levels]
        starts = np.cumsum([0, *counts])
        self.settled = int(starts[-1])
        self.ranks = [np.cumsum(bits) - 1 + start for bits, start in zip(levels, starts)]

    @classmethod
    def build(cls, keys: np.ndarray) -> "PerfectHash":
        """``keys`` are distinct unsigned 64-bit numbers."""
        levels, left = [], keys
        while len(left) and len(levels) < _MOST_LEVELS:
            size = max(8, _GAMMA * len(left))
            at = _places(left, len(levels), size)
            alone = np.bincount(at, minlength=size) == 1
            levels.append(alone)
            left = left[~alone[at]]
        return cls(levels, np.sort(left))

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key. A key that was not built in gets any slot, or -1."""
        out = np.full(len(keys), -1, dtype=np.int64)
        open_ = np.arange(len(keys))
        for level, bits in enumerate(self.levels):
            if not len(open_):
                return out
            at = _places(keys[open_], level, len(bits))
            hit = bits[at]
            out[open_[hit]] = self.ranks[level][at[hit]]
            open_ = open_[~hit]
        if len(open_) and len(self.rest):
            at = np.minimum(np.searchsorted(self.rest, keys[open_]), len(self.rest) - 1)
            same = self.rest[at] == keys[open_]
            out[open_[same]] = self.settled + at[same]
        return out

    def to_bytes(self) -> bytes:
        head = np.array([len(self.levels), len(self.rest), *map(len, self.levels)], dtype="<u8")
        body = [np.packbits(bits, bitorder="little").tobytes() for bits in self.levels]
        return head.tobytes() + b"".join(body) + self.rest.astype("<u8").tobytes()

    @classmethod
    def from_bytes(cls, data: bytes) -> tuple["PerfectHash", int]:
        """The function, and the number of bytes read."""
        n, rest = (int(x) for x in np.frombuffer(data, dtype="<u8", count=2))
        sizes = np.frombuffer(data, dtype="<u8", count=n, offset=16).astype(int)
        at, levels = 16 + 8 * n, []
        for size in sizes:
            packed = np.frombuffer(data, dtype=np.uint8, count=(size + 7) // 8, offset=at)
            levels.append(np.unpackbits(packed, bitorder="little", count=size).astype(bool))
            at += len(packed)
        left = np.frombuffer(data, dtype="<u8", count=rest, offset=at)
        return cls(levels, left), at + 8 * rest
