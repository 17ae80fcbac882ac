"""Minimal perfect hashing of distinct 64-bit keys, with the keys kept for verification.

Level by level, the keys left over are hashed into twice as many bits as there are keys; those that are alone at their
place set its bit and are done, the others go on to the next level.  A key's number is the rank of its
bit over all levels, so n keys get exactly the numbers 0 to n - 1.  The keys lie in that order beside
the bits: a looked-up key that is not the one at its number was never hashed.
"""

from __future__ import annotations

import numpy as np

_ROOM = 2


def _mix(keys: np.ndarray, level: int) -> np.ndarray:
    """A 64-bit mixing of the keys, another one for every level."""
    with np.errstate(over="ignore"):
        x = keys.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15) * np.uint64(level + 1)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


class PerfectHash:
    """``sizes``: bits per level; ``bits``: all levels' bits; ``keys``: by number."""

    def __init__(self, sizes: np.ndarray, bits: np.ndarray, keys: np.ndarray):
        self.sizes, self.bits, self.keys = sizes, bits, keys
        self.starts = np.concatenate(([0], np.cumsum(sizes)))
        self.rank = np.concatenate(([0], np.cumsum(bits, dtype=np.int64)))

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        """``keys``: distinct int64, in any order."""
        left, sizes, bits = keys, [], []
        while len(left):
            size = _ROOM * len(left)
            at = (_mix(left, len(sizes)) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(at, minlength=size) == 1
            sizes.append(size)
            bits.append(alone)
            left = left[~alone[at]]
        made = cls(np.array(sizes, np.int64), np.concatenate(bits) if bits else np.zeros(0, bool), np.zeros(len(keys), np.int64))
        made.keys[made._number(keys)] = keys
        return made

    def _number(self, keys: np.ndarray) -> np.ndarray:
        out, todo = np.full(len(keys), -1, np.int64), np.arange(len(keys))
        for level, (start, size) in enumerate(zip(self.starts, self.sizes)):
            if not len(todo):
                break
            at = start + (_mix(keys[todo], level) % np.uint64(size)).astype(np.int64)
            hit = self.bits[at]
            out[todo[hit]] = self.rank[at[hit]]
            todo = todo[~hit]
        return out

    def number(self, keys: np.ndarray) -> np.ndarray:
        """Numbers of ``keys``; -1 for a key that was not hashed."""
        n = self._number(keys)
        if len(self.keys):
            n[(n >= 0) & (self.keys[np.maximum(n, 0)] != keys)] = -1
        return n

    def pack(self) -> tuple[bytes, bytes, bytes]:
        return self.sizes.tobytes(), np.packbits(self.bits).tobytes(), self.keys.tobytes()

    @classmethod
    def unpack(cls, sizes: bytes, bits: bytes, keys: bytes) -> PerfectHash:
        s = np.frombuffer(sizes, np.int64)
        return cls(s, np.unpackbits(np.frombuffer(bits, np.uint8), count=int(s.sum())).astype(bool), np.frombuffer(keys, np.int64))
