"""Minimal perfect hashing of 64-bit keys, in shards.

Keys go to shards by one hash, so a shard holds a bounded number of distinct keys. Within a shard
a cascade of bit arrays places them: a level hashes the keys that are left into a few bits more
than there are keys; a bit hit by exactly one key belongs to it, the others go on to the next level.
A key's index is the rank of its bit over all levels, so the indices of n keys are 0 to n - 1.
A key that was never placed may also hit a set bit; callers keep the keys by index and compare.
"""

from __future__ import annotations

import numpy as np

from .common import mix64

_U = np.uint64
SHARD_KEYS = 1 << 16
ROOM = 2  # bits per key of a level
MAX_LEVELS = 60


PLACES = 1 << 20


def place_of(keys: np.ndarray) -> np.ndarray:
    """Place of each key (int64 array); its low bits are the key's shard, for any power of two of shards
    up to PLACES."""
    return (mix64(keys.view(_U) ^ _U(0x9E3779B97F4A7C15)) & _U(PLACES - 1)).astype(np.int64)


def shards_for(keys: int) -> int:
    """A power of two of shards of about SHARD_KEYS keys."""
    return min(PLACES, 1 << max(0, (max(keys, 1) - 1) // SHARD_KEYS).bit_length())


def _slots(keys: np.ndarray, level: int, size) -> np.ndarray:
    """Bit of each key at a level; ``size`` may differ from key to key."""
    seed = _U((0xD1B54A32D192ED03 * (level + 1)) & 0xFFFFFFFFFFFFFFFF)
    return (mix64(mix64(keys.view(_U) + seed) ^ seed) % size).astype(np.int64)


def build(keys: np.ndarray) -> tuple[np.ndarray, list[int]]:
    """The bits of all levels laid end to end (bool array) and the size of each level."""
    left, bits, sizes = keys, [], []
    while len(left):
        if len(sizes) >= MAX_LEVELS:
            raise ValueError("keys are not distinct")
        size = max(64, ROOM * len(left))
        at = _slots(left, len(sizes), _U(size))
        once = np.bincount(at, minlength=size) == 1
        bits.append(once)
        sizes.append(size)
        left = left[~once[at]]
    return (np.concatenate(bits) if bits else np.zeros(0, bool)), sizes


class PerfectHash:
    """Index of keys over shards; ``parts`` has ``(bits, sizes)`` of every shard in order, a power of two
    of them. One shard alone gives the index within it."""

    def __init__(self, parts: list[tuple[np.ndarray, list[int]]]):
        self.shards = max(1, len(parts))
        depth = max((len(s) for _, s in parts), default=0)
        self.size = np.zeros((self.shards, depth), np.int64)
        for i, (_, sizes) in enumerate(parts):
            self.size[i, :len(sizes)] = sizes
        starts = np.concatenate(([0], np.cumsum(self.size.ravel())))[:-1]
        self.start = starts.reshape(self.size.shape)
        self.bits = np.concatenate([b for b, _ in parts]) if parts else np.zeros(0, bool)
        # rank of a bit: set bits in the blocks before its block, and within it
        blocks = np.add.reduceat(self.bits, np.arange(0, len(self.bits), 64), dtype=np.int64) if len(self.bits) else []
        self.before = np.concatenate(([0], np.cumsum(blocks))).astype(np.int64)
        pad = np.zeros(-len(self.bits) % 64, bool)
        self.words = np.packbits(np.concatenate((self.bits, pad)), bitorder="little").view("<u8")
        del self.bits

    def index(self, keys: np.ndarray) -> np.ndarray:
        """Index of each key over all shards; -1 where no level has the key's bit."""
        out = np.full(len(keys), -1, np.int64)
        todo = np.arange(len(keys))
        shard = place_of(keys) & (self.shards - 1)
        for level in range(self.size.shape[1]):
            size = self.size[shard[todo], level]
            todo, size = todo[size > 0], size[size > 0]
            if not len(todo):
                break
            at = self.start[shard[todo], level] + _slots(keys[todo], level, size.astype(_U))
            word, bit = self.words[at >> 6], (at & 63).astype(_U)
            hit = (word >> bit) & _U(1) == 1
            below = np.bitwise_count(word & ((_U(1) << bit) - _U(1))).astype(np.int64)
            out[todo[hit]] = (self.before[at >> 6] + below)[hit]
            todo = todo[~hit]
        return out


def pack(bits: np.ndarray) -> bytes:
    return np.packbits(bits, bitorder="little").tobytes()


def unpack(data: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(data, np.uint8), bitorder="little", count=n).astype(bool)
