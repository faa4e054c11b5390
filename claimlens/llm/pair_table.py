"""A hash table from pairs of token ids to numbers, looked up for whole arrays of pairs."""

from __future__ import annotations

import numpy as np

#: What a pair that the table doesn't hold gives: more than any rank.
FREE = np.int32(2**31 - 1)
MIXER = np.uint64(0x9E3779B97F4A7C15)


class PairTable:
    """Open addressing over two arrays: a key stands in the first free slot from its hash on."""

    def __init__(self, left: np.ndarray, right: np.ndarray, value: np.ndarray):
        keys, first = np.unique(self._key(left, right), return_index=True)
        value = np.asarray(value)[first]
        bits = max(4, int(len(keys)).bit_length() + 2)
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys, self.values = np.full(1 << bits, -1, np.int64), np.full(1 << bits, FREE, np.int32)
        slot, waiting = self._slot(keys), np.arange(len(keys))
        while len(waiting):
            at = slot[waiting]
            free = self.keys[at] == -1
            self.keys[at[free]] = keys[waiting[free]]  # of several, the last one written stays
            placed = self.keys[at] == keys[waiting]
            self.values[at[placed]] = value[waiting[placed]]
            waiting = waiting[~placed]
            slot[waiting] = (slot[waiting] + 1) & self.mask

    @staticmethod
    def _key(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return np.asarray(left, np.int64) << 32 | np.asarray(right, np.int64)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * MIXER) >> self.shift).astype(np.int64)

    def get(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The value of each pair, FREE where there is none."""
        keys = self._key(left, right)
        slot = self._slot(keys)
        held = self.keys[slot]
        out = np.where(held == keys, self.values[slot], FREE)
        open_ = np.flatnonzero((held != keys) & (held != -1))
        while len(open_):
            slot[open_] = (slot[open_] + 1) & self.mask
            held = self.keys[slot[open_]]
            hit = held == keys[open_]
            out[open_[hit]] = self.values[slot[open_[hit]]]
            open_ = open_[~hit & (held != -1)]
        return out
