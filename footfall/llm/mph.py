"""Minimal perfect hashing of long keys, in numpy.

Keys are placed level by level: a key that is alone in its slot of a level's bit array
stays there, the others go on to the next level.  The rank of a key's bit over all levels
is its place.  About three bits a key; a lookup reads one bit a level, on average under
two levels.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: Bits of a level per key that reaches it.
ROOM = 2


def mixed(keys: np.ndarray, seed: int) -> np.ndarray:
    """64 well-mixed bits of each key."""
    x = keys.astype(np.int64).view(np.uint64) + np.uint64((seed * 0x9E3779B97F4A7C15 + 0x9E3779B97F4A7C15) % (1 << 64))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def fingerprints(keys: np.ndarray) -> np.ndarray:
    """32 bits of each key that no level uses."""
    return (mixed(keys, 1 << 20) >> np.uint64(32)).astype(np.uint32)


@dataclass
class PerfectHash:
    sizes: np.ndarray  # bits by level
    bits: np.ndarray  # of all levels, packed, each level from a new byte

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        """``keys`` are distinct longs; none give an empty function."""
        left, sizes, packed = np.asarray(keys, dtype=np.int64), [], []
        while len(left):
            size = max(8, ROOM * len(left))
            slot = (mixed(left, len(sizes)) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(slot, minlength=size) == 1
            sizes.append(size)
            packed.append(np.packbits(alone, bitorder="little"))
            left = left[~alone[slot]]
        return cls(np.array(sizes, dtype=np.int64), np.concatenate(packed) if packed else np.zeros(0, np.uint8))

    def places(self, keys: np.ndarray) -> np.ndarray:
        """From 0, a different place for each key of the set; other keys get any place or -1."""
        keys = np.asarray(keys, dtype=np.int64)
        found, open_ = np.full(len(keys), -1, dtype=np.int64), np.arange(len(keys))
        counts = np.concatenate([[0], np.cumsum(np.bitwise_count(self.bits), dtype=np.int64)])
        start = 0
        for level, size in enumerate(self.sizes.tolist()):
            if not len(open_):
                break
            slot = (mixed(keys[open_], level) % np.uint64(size)).astype(np.int64)
            byte = self.bits[start + (slot >> 3)]
            hit = (byte >> (slot & 7).astype(np.uint8)) & 1 == 1
            below = np.bitwise_count(byte & ((1 << (slot & 7)) - 1).astype(np.uint8))
            found[open_[hit]] = (counts[start + (slot >> 3)] + below)[hit]
            open_ = open_[~hit]
            start += -(-size // 8)
        return found
