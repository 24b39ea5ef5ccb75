"""A run-length grammar of number sequences by recompression, and longest common extensions over it.

Rounds of block compression (x x x to one symbol) and pair compression (x y to one symbol, where x has one
colour and y the other) shrink a sequence to one symbol. Whether two neighbours are joined depends on them
alone, so equal stretches get equal symbols but for their edges. An extension query climbs the levels
from its two positions, comparing only until both stand at the start of a symbol, and comes down again.
"""

from __future__ import annotations

import numpy as np

from affilspark.llm._words import mix

Level = tuple[np.ndarray, np.ndarray, np.ndarray, bool]


class Grammar:
    """Levels over sequences that stand between separators (all distinct, also one before the first and after the last).

    A level has its symbols, the parent of each, the first child of each parent (and the end), and whether
    its parents are blocks. Separators are never joined, so no extension passes one.
    """

    def __init__(self, symbols: np.ndarray, separators: np.ndarray):
        fixed = np.zeros(len(symbols), bool)
        fixed[separators] = True
        fresh, salt = int(symbols.max()) + 1, 0
        self.levels: list[Level] = []
        s, filled = symbols.astype(np.int64), int((np.diff(separators) > 1).sum())
        while len(s) > len(separators) + filled:
            for block in (True, False):
                if block:
                    joined = s[1:] == s[:-1]
                else:
                    colour = (mix(s.astype(np.uint64) + np.uint64(salt)) >> np.uint64(17)) & np.uint64(1) == 1
                    free = ~(fixed[1:] | fixed[:-1])
                    up, down = free & ~colour[:-1] & colour[1:], free & colour[:-1] & ~colour[1:]
                    joined = up if up.sum() >= down.sum() else down
                    salt = (salt + 0x9E3779B97F4A7C15) % (1 << 64)  # other colours in each round
                if not joined.any():
                    continue
                head = np.r_[True, ~joined]
                first = np.r_[np.flatnonzero(head), len(s)]
                size = np.diff(first)
                many = first[:-1][size > 1]
                names, which = np.unique(s[many] * np.int64(fresh + len(s)) + (size[size > 1] if block else s[many + 1]), return_inverse=True)
                self.levels.append((s, np.cumsum(head) - 1, first, block))
                s, fixed = s[first[:-1]], fixed[first[:-1]]
                s[size > 1] = fresh + which
                fresh += len(names)
        self.top = s

    def extend(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many symbols from positions a and b onward are equal, for each pair a < b."""
        return _extend(self.levels, self.top, a, b)

    def extend_back(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many symbols up to and with positions a and b, going left, are equal."""
        mirrored = [(s[::-1], len(first) - 2 - parent[::-1], len(s) - first[::-1], block) for s, parent, first, block in self.levels]
        n = len(self.levels[0][0]) if self.levels else len(self.top)
        return _extend(mirrored, self.top[::-1], n - 1 - b, n - 1 - a)


def _extend(levels: list[Level], top: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    begun, who = a, np.arange(len(a))
    stuck = []
    for s, parent, first, block in levels:
        halt = s[a] != s[b]
        if block:
            inside = ~halt & ((first[parent[a]] != a) | (first[parent[b]] != b))
            left, right = first[parent[a] + 1] - a, first[parent[b] + 1] - b
            step = np.where(inside, np.minimum(left, right), 0)
            a, b = a + step, b + step
            halt |= inside & (left != right)
        else:
            while True:
                inside = ~halt & ((first[parent[a]] != a) | (first[parent[b]] != b))
                if not inside.any():
                    break
                a, b = a + inside, b + inside
                halt |= s[a] != s[b]
        stuck.append((who[halt], a[halt], b[halt]))
        a, b, who = parent[a[~halt]], parent[b[~halt]], who[~halt]
    while len(same := np.flatnonzero(top[a] == top[b])):
        a[same] += 1
        b[same] += 1
    for (s, parent, first, block), (w, x, y) in zip(reversed(levels), reversed(stuck), strict=True):
        a, b = first[a], first[b]
        same = s[a] == s[b]  # of two different parents only the first child, or the shorter block, can be shared
        step = np.where(same, np.minimum(first[parent[a] + 1] - a, first[parent[b] + 1] - b) if block else 1, 0)
        a, b, who = np.r_[a + step, x], np.r_[b + step, y], np.r_[who, w]
    out = np.empty(len(begun), np.int64)
    out[who] = a
    return out - begun
