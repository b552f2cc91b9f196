"""Entry numbers of byte strings, by hash, for many strings at once."""

from __future__ import annotations

import numpy as np


class HashIndex:
    """Open addressing, filled to a half at most. ``checks`` are a second key beside the hash."""

    def __init__(self, bits: int):
        self.mask = (1 << bits) - 1
        self.keys = np.zeros(1 << bits, np.uint64)
        self.checks = np.zeros(1 << bits, np.int64)
        self.entry = np.full(1 << bits, -1, np.int32)
        self.room = 1 << (bits - 1)
        self.size = 0

    def clear(self) -> None:
        self.entry[:] = -1
        self.size = 0

    def find(self, keys: np.ndarray, checks: np.ndarray) -> np.ndarray:
        """The entries, or -1."""
        slot = (keys & np.uint64(self.mask)).astype(np.int64)
        entry = self.entry.take(slot)
        same = (entry >= 0) & (self.keys.take(slot) == keys) & (self.checks.take(slot) == checks)
        found = np.where(same, entry, np.int32(-1))
        left = np.flatnonzero((entry >= 0) > same)
        slot = (slot.take(left) + 1) & self.mask
        while len(left):
            entry = self.entry.take(slot)
            same = (entry >= 0) & (self.keys.take(slot) == keys.take(left)) & (self.checks.take(slot) == checks.take(left))
            found[left[same]] = entry[same]
            on = np.flatnonzero((entry >= 0) > same)
            left, slot = left.take(on), (slot.take(on) + 1) & self.mask
        return found

    def add(self, keys: np.ndarray, checks: np.ndarray) -> None:
        """New and distinct entries, numbered in order."""
        left, slot = np.arange(len(keys)), (keys & np.uint64(self.mask)).astype(np.int64)
        while len(left):
            free = np.flatnonzero(self.entry[slot] < 0)
            _, first = np.unique(slot[free], return_index=True)
            won = free[first]
            self.keys[slot[won]], self.checks[slot[won]] = keys[left[won]], checks[left[won]]
            self.entry[slot[won]] = self.size + left[won]
            on = np.delete(np.arange(len(left)), won)
            left, slot = left[on], (slot[on] + 1) & self.mask
        self.size += len(keys)


def checks_of(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Length, first and last byte of each span."""
    return ((ends - starts) << 16) | (data[starts].astype(np.int64) << 8) | data[ends - 1]
