"""A minimal perfect hash over 64-bit keys, as plain arrays.

Level by level, every key still left marks one bit of that level's bit array; a bit that exactly one key
marked is that key's, the others go on to the next level. A key's index is the number of set bits before
its own. About four bits a key; building and looking up are array operations.
"""

from __future__ import annotations

import numpy as np

from podwatch.llm.minhash import mixed

SLACK = 2  # bits a key in each level
WORD = 64


def _places(keys: np.ndarray, level: int, bits: int) -> np.ndarray:
    spread = mixed(keys + np.uint64((level + 1) * 0x9E3779B97F4A7C15 % 2**64))
    return ((spread >> np.uint64(32)) * np.uint64(bits) >> np.uint64(32)).astype(np.int64)


def build(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Level sizes in bits, the bit arrays one after another, and the index of every key. Keys are distinct."""
    sizes, marks, index = [], [], np.full(len(keys), -1, dtype=np.int64)
    left, before = np.arange(len(keys)), 0
    while len(left):
        bits = -(-max(SLACK * len(left), WORD) // WORD) * WORD
        at = _places(keys[left], len(sizes), bits)
        alone = np.bincount(at, minlength=bits) == 1
        own = alone[at]
        rank = np.cumsum(alone) - 1 + before
        index[left[own]] = rank[at[own]]
        sizes.append(bits)
        marks.append(alone)
        before += int(alone.sum())
        left = left[~own]
    flat = np.concatenate(marks) if marks else np.zeros(0, dtype=bool)
    return np.array(sizes, dtype=np.int64), np.packbits(flat), index


def lookup(keys: np.ndarray, sizes: np.ndarray, packed: np.ndarray) -> np.ndarray:
    """Index of each key, or -1 where no level has a bit for it. An absent key may get any index."""
    flat = np.unpackbits(packed).astype(bool)
    ranks = np.cumsum(flat) - 1
    out, left, start = np.full(len(keys), -1, dtype=np.int64), np.arange(len(keys)), 0
    for level, bits in enumerate(sizes.tolist()):
        at = start + _places(keys[left], level, bits)
        hit = flat[at]
        out[left[hit]] = ranks[at[hit]]
        left, start = left[~hit], start + bits
    return out
