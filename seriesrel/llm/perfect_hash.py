"""A minimal perfect hash of distinct 64-bit keys, with the keys kept to verify look-ups.

Built level by level: each key hashes into a bit array of twice the number of keys
left, keys alone at their bit are placed there, the others go to the next level. A
key's index is the number of set bits before its own over all levels.
"""

from __future__ import annotations

import numpy as np

from seriesrel.llm.text import U, mix

ROOM = 2.0
BLOCK = 64


def _places(keys: np.ndarray, level: int, size: int) -> np.ndarray:
    return (mix(keys.view(U) + U((level + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)) % U(size)).astype(np.int64)


class PerfectHash:
    def __init__(self, keys: np.ndarray):
        """``keys``: distinct int64 values."""
        keys = np.ascontiguousarray(keys, np.int64)
        self.starts, words, start, left = [0], [], 0, keys
        while len(left):
            size = -(-max(int(ROOM * len(left)), 1) // BLOCK) * BLOCK
            at = _places(left, len(words), size)
            single = np.bincount(at, minlength=size) == 1
            words.append(np.packbits(single, bitorder="little").view("<u8"))
            left = left[~single[at]]
            start += size
            self.starts.append(start)
        self.words = np.concatenate(words) if words else np.zeros(0, U)
        self.before = np.concatenate(([0], np.cumsum(np.bitwise_count(self.words).astype(np.int64))))
        self.keys = np.zeros(len(keys), np.int64)
        self.keys[self._index(keys)] = keys

    def __len__(self) -> int:
        return len(self.keys)

    def _index(self, keys: np.ndarray) -> np.ndarray:
        out = np.full(len(keys), -1, np.int64)
        todo = np.arange(len(keys))
        for level in range(len(self.starts) - 1):
            if not len(todo):
                break
            start, end = self.starts[level], self.starts[level + 1]
            at = start + _places(keys[todo], level, end - start)
            word, bit = self.words[at // BLOCK], (at % BLOCK).astype(U)
            hit = (word >> bit) & U(1) == 1
            rank = self.before[at // BLOCK] + np.bitwise_count(word & ((U(1) << bit) - U(1)))
            out[todo[hit]] = rank[hit]
            todo = todo[~hit]
        return out

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Index of each key, -1 if it is not one of the hashed keys."""
        keys = np.ascontiguousarray(keys, np.int64)
        if not len(self.keys):
            return np.full(len(keys), -1, np.int64)
        at = self._index(keys)
        return np.where((at >= 0) & (self.keys[at] == keys), at, -1)
