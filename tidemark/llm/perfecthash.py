"""A minimal perfect hash over integer keys, with fingerprints, as flat arrays.

Keys go through levels of bit arrays: on each level a key takes a bit by hash, keys that
share a bit go on to the next. A key's slot is the number of bits set before its own, so
n keys use the slots 0 to n - 1 and a lookup costs a few probes whatever n is. The keys
themselves are not stored; a 32-bit fingerprint per slot turns away keys that were never
added, but for about one in four thousand million.
"""

from __future__ import annotations

import struct

import numpy as np

MAGIC = b"MPH1"
SPREAD = 2
FINGERPRINT = 0x9E37


def mix(keys: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit finaliser over ``keys`` and ``seed``; one to one for a seed."""
    x = keys.astype(np.int64).view(np.uint64) + np.uint64(
        (seed + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF
    )
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class PerfectHash:
    def __init__(self, levels: list[np.ndarray], fingerprints: np.ndarray):
        self.levels, self.fingerprints = levels, fingerprints
        self.ranks, before = [], 0
        for bits in levels:
            self.ranks.append(before + np.cumsum(bits, dtype=np.int64) - bits)
            before += int(bits.sum())

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        """``keys`` must be distinct."""
        left, levels = np.asarray(keys, np.int64), []
        while len(left):
            size = SPREAD * len(left) + 1
            at = (mix(left, len(levels)) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(at, minlength=size) == 1
            levels.append(alone)
            left = left[~alone[at]]
        made = cls(levels, np.zeros(len(keys), np.uint32))
        made.fingerprints[made._slots(keys)] = made._prints(keys)
        return made

    @staticmethod
    def _prints(keys: np.ndarray) -> np.ndarray:
        return (mix(keys, FINGERPRINT) >> np.uint64(32)).astype(np.uint32)

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        keys = np.asarray(keys, np.int64)
        slots, left = np.full(len(keys), -1), np.arange(len(keys))
        for level, (bits, ranks) in enumerate(zip(self.levels, self.ranks, strict=True)):
            at = (mix(keys[left], level) % np.uint64(len(bits))).astype(np.int64)
            own = bits[at]
            slots[left[own]] = ranks[at[own]]
            left = left[~own]
        return slots

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key, -1 where the fingerprint says that it was never added."""
        slots = self._slots(keys)
        held = slots >= 0
        held[held] = self.fingerprints[slots[held]] == self._prints(np.asarray(keys)[held])
        return np.where(held, slots, -1)

    def to_bytes(self) -> bytes:
        sizes = [len(bits) for bits in self.levels]
        head = struct.pack(f"<4sQI{len(sizes)}Q", MAGIC, len(self.fingerprints), len(sizes), *sizes)
        return b"".join(
            [head, *[np.packbits(b).tobytes() for b in self.levels], self.fingerprints.tobytes()]
        )

    @classmethod
    def from_bytes(cls, raw: bytes) -> PerfectHash:
        magic, n, depth = struct.unpack_from("<4sQI", raw)
        if magic != MAGIC:
            raise ValueError("not a perfect hash")
        sizes = struct.unpack_from(f"<{depth}Q", raw, 16)
        at, levels = 16 + 8 * depth, []
        for size in sizes:
            packed = np.frombuffer(raw, np.uint8, (size + 7) // 8, at)
            levels.append(np.unpackbits(packed, count=size).astype(bool))
            at += len(packed)
        return cls(levels, np.frombuffer(raw, "<u4", n, at).copy())
