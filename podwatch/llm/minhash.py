"""One-permutation minimum hashing with optimal densification, on arrays of 64-bit hashes."""

from __future__ import annotations

from functools import lru_cache

import numpy as np

U = np.uint64


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> U(33))
    x = x * U(0xFF51AFD7ED558CCD)
    x = x ^ (x >> U(33))
    x = x * U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> U(33))


@lru_cache(maxsize=8)
def multipliers(n: int) -> np.ndarray:
    return mixed(np.arange(1, n + 1, dtype=np.uint64)) | U(1)


@lru_cache(maxsize=8)
def probe_order(bins: int) -> np.ndarray:
    """Row i has all bins in the random order in which an empty bin i looks for a full one."""
    order = np.empty((bins, bins), dtype=np.int16)
    for i in range(bins):  # row by row, as a worker keeps what larger arrays took
        order[i] = mixed(np.arange(i * bins, (i + 1) * bins, dtype=np.uint64) + U(0x9E3779B97F4A7C15)).argsort()
    return order


@lru_cache(maxsize=8)
def probe_ranks(bins: int) -> np.ndarray:
    """Row i has the place of each bin in row i of ``probe_order``."""
    ranks = np.empty((bins, bins), dtype=np.int16)
    np.put_along_axis(ranks, probe_order(bins), np.arange(bins, dtype=np.int16)[None, :], axis=1)
    return ranks


def _donors(full: np.ndarray, bins: int) -> tuple[np.ndarray, np.ndarray]:
    """The empty bins, and for each the first full bin in its own order."""
    known = np.zeros(bins, dtype=bool)
    known[full] = True
    empty = np.flatnonzero(~known)
    if len(full) * 8 < bins:  # few full bins: look at the ranks of all of them at once
        return empty, full[probe_ranks(bins)[empty][:, full].argmin(axis=1)]
    order, donors = probe_order(bins), np.empty(len(empty), dtype=np.int64)
    left, step = np.arange(len(empty)), 0
    while len(left):  # many: a few probes find one
        seen = order[empty[left], step]
        hit = known[seen]
        donors[left[hit]] = seen[hit]
        left, step = left[~hit], step + 1
    return empty, donors


def one_permutation(hashes: np.ndarray, bins: int) -> np.ndarray:
    """Minimum of each bin; an empty bin borrows from the full bin that its own random order meets first.

    ``hashes`` is sorted, distinct and not empty. The bin is taken from the high bits, so a bin's hashes lie
    together and its first is its minimum.
    """
    at = ((hashes >> U(32)) * U(bins) >> U(32)).astype(np.int64)
    first = np.empty(len(at), dtype=bool)
    first[0] = True
    np.not_equal(at[1:], at[:-1], out=first[1:])
    full = at[first]
    out = np.zeros(bins, dtype=np.uint64)
    out[full] = hashes[first]
    if len(full) < bins:
        empty, donors = _donors(full, bins)
        out[empty] = out[donors]
    return out


def bands(signature: np.ndarray, rows: int) -> np.ndarray:
    """One 64-bit key per band of ``rows`` bins."""
    cells = signature.reshape(-1, rows)
    keys = (mixed(cells) * multipliers(rows)).sum(axis=1, dtype=np.uint64)
    return mixed(keys ^ multipliers(len(cells)))


def one_bit_sketch(signature: np.ndarray) -> np.ndarray:
    """One bit per bin, as 64-bit words; two sets of similarity J differ in (1 - J) / 2 of the bits.

    The bin is part of what is hashed, so bins that hold the same minimum still give bits of their own.
    """
    return np.packbits((mixed(signature ^ multipliers(len(signature))) >> U(63)).astype(np.uint8)).view(np.int64)


def parity_sketch(hashes: np.ndarray, bits: int) -> np.ndarray:
    """Parity of the number of hashes at each of ``bits`` places, as 64-bit words.

    Two sets never differ in more places than they have elements that are in one of them only.
    """
    at = ((hashes >> U(32)) * U(bits) >> U(32)).astype(np.int64)
    return np.packbits((np.bincount(at, minlength=bits) & 1).astype(np.uint8)).view(np.int64)
