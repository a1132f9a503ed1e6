"""Minimal perfect hashing of 64-bit key hashes by a cascade of collision-free bit arrays (Limasset and others, 2017).

A key takes the first level at which no other key shares its bit; its value is that bit's rank, so n keys
get the values 0 .. n - 1 in about 3 bits each. Keys outside the set get any value or -1: callers keep fingerprints.
"""

from __future__ import annotations

import numpy as np

GAMMA = 1.6
MAX_LEVELS = 64


def _mix(keys: np.ndarray, level: int) -> np.ndarray:
    """A fresh hash of the keys for each level (the splitmix64 finaliser)."""
    with np.errstate(over="ignore"):
        x = keys + np.uint64((0x9E3779B97F4A7C15 * (level + 1)) & 0xFFFFFFFFFFFFFFFF)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


class MinimalPerfectHash:
    def __init__(self, levels: list[np.ndarray]):
        """levels: each a uint64 bit array."""
        self.levels = levels
        self.bits = [np.unpackbits(x.view(np.uint8), bitorder="little") for x in levels]
        self.ranks, at = [], 0
        for b in self.bits:
            r = np.cumsum(b, dtype=np.int64) - 1 + at
            self.ranks.append(r)
            at += int(b.sum())
        self.size = at

    @classmethod
    def build(cls, keys: np.ndarray) -> MinimalPerfectHash:
        """keys: distinct uint64 values."""
        left, levels = np.asarray(keys, dtype=np.uint64), []
        while len(left):
            if len(levels) == MAX_LEVELS:
                raise ValueError("the keys aren't distinct")
            m = -(-max(64, int(GAMMA * len(left))) // 64) * 64
            at = (_mix(left, len(levels)) % np.uint64(m)).astype(np.int64)
            alone = np.bincount(at, minlength=m) == 1
            levels.append(np.packbits(alone, bitorder="little").view(np.uint64))
            left = left[~alone[at]]
        return cls(levels)

    def lookup(self, keys: np.ndarray) -> np.ndarray:
        keys = np.asarray(keys, dtype=np.uint64)
        out, todo = np.full(len(keys), -1, dtype=np.int64), np.arange(len(keys))
        for level, (bits, ranks) in enumerate(zip(self.bits, self.ranks)):
            if not len(todo):
                break
            at = (_mix(keys[todo], level) % np.uint64(len(bits))).astype(np.int64)
            hit = bits[at] == 1
            out[todo[hit]] = ranks[at[hit]]
            todo = todo[~hit]
        return out

    def to_bytes(self) -> bytes:
        head = np.array([len(self.levels), *(len(x) for x in self.levels)], dtype="<u4").tobytes()
        return head + b"".join(x.astype("<u8").tobytes() for x in self.levels)

    @classmethod
    def from_bytes(cls, data: bytes) -> MinimalPerfectHash:
        n = int(np.frombuffer(data, "<u4", 1)[0])
        sizes = np.frombuffer(data, "<u4", n, 4).tolist()
        at, levels = 4 + 4 * n, []
        for s in sizes:
            levels.append(np.frombuffer(data, "<u8", s, at).astype(np.uint64))
            at += 8 * s
        return cls(levels)
