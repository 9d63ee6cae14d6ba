"""Suffix arrays of many texts of numbers at once, with their LCP intervals. Arrays only, no tree nodes."""

from __future__ import annotations

import numpy as np


class Suffixes:
    """Enhanced suffix array of several texts that lie one behind the other.

    ``symbols`` holds the texts, each closed by a symbol that occurs nowhere else; symbols of different texts
    differ, so no suffix meets one of another text. ``sa`` has the places in order of their suffixes, ``isa``
    the inverse, ``lcp[k]`` the common length of the suffixes ``k - 1`` and ``k``.
    """

    def __init__(self, symbols: np.ndarray) -> None:
        m = len(symbols)
        self.symbols = symbols
        sa = np.argsort(symbols, kind="stable")
        ordered = symbols[sa]
        fresh = np.empty(m, dtype=bool)
        fresh[:1] = True
        np.not_equal(ordered[1:], ordered[:-1], out=fresh[1:])
        # The rank of a suffix is the first place of those it cannot be told apart from yet.
        rank = np.empty(m, dtype=np.int32)
        rank[sa] = np.maximum.accumulate(np.where(fresh, np.arange(m), 0))
        levels = [rank]  # at 1, 2, 4, ... symbols
        step = 1
        alone = fresh & np.append(fresh[1:], True)
        active = np.flatnonzero(~alone)
        while len(active):
            at = sa[active]
            key = rank[at].astype(np.int64) * m + rank[at + step]
            order = np.argsort(key, kind="stable")
            key, at = key[order], at[order]
            sa[active] = at
            fresh = np.empty(len(active), dtype=bool)
            fresh[0] = True
            np.not_equal(key[1:], key[:-1], out=fresh[1:])
            rank = rank.copy()
            rank[at] = active[np.maximum.accumulate(np.where(fresh, np.arange(len(active)), 0))]
            levels.append(rank)
            active = active[~(fresh & np.append(fresh[1:], True))]
            step *= 2
        self.sa, self.isa = sa, rank
        self.lcp = self._common(levels)

    def _common(self, levels: list[np.ndarray]) -> np.ndarray:
        """Longest common prefixes of neighbours: as many symbols at once as still agree, most first."""
        lcp = np.zeros(len(self.sa), dtype=np.int32)
        pairs = np.flatnonzero(self.symbols[self.sa[1:]] == self.symbols[self.sa[:-1]]) + 1
        a, b = self.sa[pairs - 1], self.sa[pairs]
        length = np.zeros(len(pairs), dtype=np.int32)
        for level in range(len(levels) - 1, -1, -1):
            same = levels[level][a] == levels[level][b]
            step = same * np.int32(1 << level)
            length += step
            a, b = a + step, b + step
        lcp[pairs] = length
        return lcp

    def intervals(self, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """LCP intervals of at least ``least`` suffixes: (first, last, depth) of each, and the borders between children.

        Borders are rows (interval, place): a child of the interval begins there; another begins at its first suffix.
        """
        lcp = self.lcp
        m = len(lcp)
        places = np.flatnonzero(lcp)
        if not len(places):
            none = np.empty(0, dtype=np.int64)
            return none, none, none, np.empty((0, 2), dtype=np.int64)
        value = np.append(lcp, -1)  # beyond the end, and, by index -1, before the start
        first = self._smaller(value, places, -1)
        last = self._smaller(value, places, 1) - 1
        wide = last - first + 1 >= least
        places, first, last = places[wide], first[wide], last[wide]
        # Borders of one interval have its first suffix and its depth in common.
        order = np.argsort(first * (m + 1) + last, kind="stable")
        places, first, last = places[order], first[order], last[order]
        fresh = np.ones(len(places), dtype=bool)
        fresh[1:] = (first[1:] != first[:-1]) | (last[1:] != last[:-1])
        number = np.cumsum(fresh) - 1
        return first[fresh], last[fresh], lcp[places[fresh]].astype(np.int64), np.stack([number, places], axis=1)

    @staticmethod
    def _smaller(value: np.ndarray, places: np.ndarray, way: int) -> np.ndarray:
        """The nearest place with a smaller value on one side of each place; pointers skip over pointers."""
        m = len(value) - 1
        to = np.arange(m + 1) + way
        to[m] = m
        active = places
        while len(active):
            active = active[value[to[active]] >= value[active]]
            to[active] = to[to[active]]
        return to[places]
