"""Minimal perfect hash of 64-bit keys: levels of bit arrays, where a key stays at the first level at which
no other key falls on its bit, and its slot is the number of bits set before it (the published BBHash
scheme). About 3 bits a key; a look-up reads a few bits whatever the number of keys."""

from __future__ import annotations

import numpy as np

from mapstrata.llm.words import mixed

GAMMA = 2.0
MOST_LEVELS = 64


def _at(keys: np.ndarray, level: int, size: int) -> np.ndarray:
    return (mixed(keys + np.uint64(level * 0x9E3779B97F4A7C15 % (1 << 64))) % np.uint64(size)).astype(np.int64)


class PerfectHash:
    def __init__(self, bits: np.ndarray, sizes: np.ndarray) -> None:
        self.bits, self.sizes = bits, sizes
        self.begins = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        self.ranks = np.concatenate([[0], np.cumsum(bits, dtype=np.int64)])

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        """``keys``: distinct 64-bit numbers."""
        levels, sizes, left = [], [], keys.astype(np.uint64)
        while len(left):
            if len(levels) == MOST_LEVELS:
                raise ValueError("keys are not distinct")
            size = max(1, int(GAMMA * len(left)))
            at = _at(left, len(levels), size)
            alone = np.bincount(at, minlength=size) == 1
            levels.append(alone)
            sizes.append(size)
            left = left[~alone[at]]
        bits = np.concatenate(levels) if levels else np.zeros(0, dtype=bool)
        return cls(bits, np.array(sizes, dtype=np.int64))

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """Slot of every key; -1, or any slot, for keys that were not built in."""
        out = np.full(len(keys), -1, dtype=np.int64)
        open_, keys = np.arange(len(keys)), keys.astype(np.uint64)
        for level, size in enumerate(self.sizes):
            if not len(open_):
                break
            at = self.begins[level] + _at(keys[open_], level, int(size))
            hit = self.bits[at]
            out[open_[hit]] = self.ranks[at[hit]]
            open_ = open_[~hit]
        return out
