"""Static binary-fuse filters (Graf and Lemire) over 64-bit keys, in numpy.

A filter is built once for an immutable set and never changed. A key maps to three
slots in consecutive segments; the exclusive-or of the slots is the key's
fingerprint. Keys of the set always test positive, others with chance 2**-8.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

_M1 = np.uint64(0xFF51AFD7ED558CCD)
_M2 = np.uint64(0xC4CEB9FE1A85EC53)


def _mix(keys: np.ndarray, seed: int) -> np.ndarray:
    """64-bit finaliser over key + seed."""
    with np.errstate(over="ignore"):
        h = keys + np.uint64(seed)
        h = (h ^ (h >> np.uint64(33))) * _M1
        h = (h ^ (h >> np.uint64(33))) * _M2
        return h ^ (h >> np.uint64(33))


@dataclass(frozen=True)
class FuseFilter:
    seed: int
    segment: int  # slots in a segment, a power of two
    segments: int
    slots: bytes

    def contains(self, keys: np.ndarray) -> np.ndarray:
        if not self.slots:
            return np.zeros(len(keys), bool)
        table = np.frombuffer(self.slots, np.uint8)
        at, mark = _places(np.asarray(keys).astype(np.uint64), self.seed, self.segment, self.segments)
        return (table[at[0]] ^ table[at[1]] ^ table[at[2]]) == mark


def _places(keys: np.ndarray, seed: int, segment: int, segments: int):
    h = _mix(keys, seed)
    first = ((h >> np.uint64(32)) % np.uint64(segments - 2)).astype(np.int64)
    mask = np.uint64(segment - 1)
    low = [(h & mask), ((h >> np.uint64(16)) ^ (h << np.uint64(7))) & mask, ((h >> np.uint64(24)) ^ (h >> np.uint64(41))) & mask]
    at = np.stack([(first + i) * segment + low[i].astype(np.int64) for i in range(3)])
    return at, (h >> np.uint64(56)).astype(np.uint8) ^ (h & np.uint64(0xFF)).astype(np.uint8)


def build(keys: np.ndarray) -> FuseFilter:
    """A filter of the distinct `keys`; peeled in rounds, filled in the reverse order."""
    keys = np.unique(np.asarray(keys).astype(np.uint64))
    n = len(keys)
    if n == 0:
        return FuseFilter(0, 1, 3, b"")
    segment = 1 << max(2, int(np.log(max(n, 2)) / np.log(3.33) + 2.25))
    factor = max(1.125, 0.875 + 0.25 * np.log(1e6) / np.log(max(n, 2)))
    for attempt in range(200):
        # more room after failures, so small sets end too
        segments = max(3, int(np.ceil(n * factor * (1 + attempt / 10) / segment)) + 2)
        seed = 0x9E3779B97F4A7C15 * (attempt + 1) % (1 << 64)
        at, mark = _places(keys, seed, segment, segments)
        order = _peel(at, segment * segments)
        if order is not None:
            slots = np.zeros(segment * segments, np.uint8)
            for which, slot in reversed(order):
                a, b, c = at[:, which]
                slots[slot] = 0
                slots[slot] = mark[which] ^ slots[a] ^ slots[b] ^ slots[c]
            return FuseFilter(seed, segment, segments, slots.tobytes())
    raise ValueError("no seed peels this set")


def _peel(at: np.ndarray, size: int):
    """Rounds of (keys, slot in which each is alone), or None if some keys never are."""
    n, rounds = at.shape[1], []
    count = np.bincount(at.ravel(), minlength=size)
    owner = np.zeros(size, np.int64)  # exclusive-or of the keys in a slot: the key where it is alone
    for row in at:
        np.bitwise_xor.at(owner, row, np.arange(n))
    slots = np.flatnonzero(count == 1)
    left = n
    while len(slots):
        which, first = np.unique(owner[slots], return_index=True)
        slot = slots[first]
        rounds.append((which, slot))
        left -= len(which)
        for row in at[:, which]:
            np.subtract.at(count, row, 1)
            np.bitwise_xor.at(owner, row, which)
        touched = np.unique(at[:, which])
        slots = touched[count[touched] == 1]
    return rounds if left == 0 else None
