"""Run-length grammars by recompression, and longest common extensions on them (numpy).

Recompression (Jez): rounds of block compression (a maximal run of one letter becomes one letter)
and pair compression (the alphabet is split in two; every left letter followed by a right one
becomes one letter) shrink a string by a quarter per round on average. Equal substrings are parsed
alike except at their borders, so two extensions are compared from letters up to the largest common
blocks and down again, with at most one step per level (I, 2017). No hashing: results are exact.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: Rounds at most; what is not compressed by then is compared letter by letter of the last level.
MOST_ROUNDS = 96


@dataclass
class Level:
    """A string of the grammar: its letters, where each starts in the text, and, towards the next level,
    the parent of each letter and the first child of each parent."""
    letters: np.ndarray
    starts: np.ndarray
    blocks: bool                 # the next level comes from block compression
    parent: np.ndarray | None = None
    first: np.ndarray | None = None


def _side(letters: np.ndarray, level: int) -> np.ndarray:
    """Whether each letter is a right one, by a multiplicative hash: half of the alphabet each."""
    mixed = (letters.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15 * (level + 1) & (1 << 64) - 1)) * np.uint64(0xBF58476D1CE4E5B9)
    mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0x94D049BB133111EB)
    return (mixed >> np.uint64(63)).astype(bool)


def _named(key: np.ndarray, following: int) -> tuple[np.ndarray, int]:
    """New letters, one per distinct key, from ``following`` on, and the next free letter."""
    import pandas as pd
    codes, distinct = pd.factorize(key)
    return codes + following, following + len(distinct)


class Grammar:
    """The levels of ``text`` (non-negative integers). Its first and last letter must occur only once,
    so that every extension ends inside."""

    def __init__(self, text: np.ndarray, smallest: int = 2):
        letters = np.asarray(text, np.int64)
        following = int(letters.max()) + 1 if len(letters) else 0
        starts = np.arange(len(letters), dtype=np.int32)
        self.levels: list[Level] = []
        for round_ in range(2 * MOST_ROUNDS):
            blocks = round_ % 2 == 0
            level = Level(letters, starts, blocks)
            self.levels.append(level)
            n = len(letters)
            if n <= smallest:
                break
            if blocks:
                begins = np.empty(n, bool)
                begins[0] = True
                np.not_equal(letters[1:], letters[:-1], out=begins[1:])
            else:
                right = _side(letters, round_)
                begins = np.ones(n, bool)
                begins[1:] = right[:-1] | ~right[1:]
            first = np.flatnonzero(begins).astype(np.int32)
            level.first = first
            level.parent = np.cumsum(begins, dtype=np.int32) - np.int32(1)
            size = np.diff(first, append=n)
            joined = size > 1
            above = letters[first]
            if joined.any():
                at = first[joined]
                other = size[joined].astype(np.int64) if blocks else letters[at + 1]
                above = above.copy()
                above[joined], following = _named(above[joined] * (max(following, n) + 1) + other, following)
            letters, starts = above, starts[first]
        # the top level is compared letter by letter
        self.levels[-1].parent = self.levels[-1].first = None

    def extend(self, i: np.ndarray, j: np.ndarray, back: bool = False) -> np.ndarray:
        """Longest common extensions: of the suffixes at ``i`` and ``j`` (i < j), or, with ``back``, of the
        prefixes that end before them."""
        top = len(self.levels) - 1
        step = -1 if back else 1
        ki, kj = (i - 1, j - 1) if back else (i.copy(), j.copy())
        stop = np.full(len(i), -1, np.int64)
        open_ = np.arange(len(i))
        # upwards: skip what does not end a parent on this side, then go to the parents
        for at, level in enumerate(self.levels):
            letters = level.letters
            a, b = ki[open_], kj[open_]
            if at == top:
                live = np.arange(len(a))
                while len(live):
                    live = live[letters[a[live]] == letters[b[live]]]
                    a[live] += step
                    b[live] += step
                ki[open_], kj[open_], stop[open_] = a, b, at
                break
            same = letters[a] == letters[b]
            inside = same & ~(self._outer(level, a, back) & self._outer(level, b, back))
            skip = np.flatnonzero(inside)
            if len(skip):
                moved = self._common(level, a[skip], b[skip], back) * step
                a[skip] += moved
                b[skip] += moved
                # they meet the border of a parent together, or differ in the next letter
                same[skip] = letters[a[skip]] == letters[b[skip]]
            ki[open_], kj[open_] = a, b
            stop[open_[~same]] = at
            open_ = open_[same]
            if not len(open_):
                break
            ki[open_], kj[open_] = level.parent[ki[open_]], level.parent[kj[open_]]
        # downwards: from the first different letters to those of the text
        highest = int(stop.max()) if len(stop) else -1
        for at in range(highest, -1, -1):
            level = self.levels[at]
            down = np.flatnonzero(stop >= at)
            a, b = ki[down], kj[down]
            if at < top:
                # letters reached from above: the ones of different parents agree in one step at most
                below = stop[down] > at
                if below.any():
                    a[below], b[below] = self._child(level, a[below], back), self._child(level, b[below], back)
                    same = np.flatnonzero(below & (level.letters[a] == level.letters[b]))
                    if len(same):
                        moved = self._common(level, a[same], b[same], back) * step
                        a[same] += moved
                        b[same] += moved
                    ki[down], kj[down] = a, b
        return (i - 1 - ki) if back else (ki - i)

    @staticmethod
    def _outer(level: Level, k: np.ndarray, back: bool) -> np.ndarray:
        """Whether letter k is the first (with ``back``: last) child of its parent."""
        parent = level.parent[k]
        if not back:
            return level.first[parent] == k
        last = np.append(level.first, len(level.letters))[parent + 1] - 1 if len(k) else k
        return last == k

    @staticmethod
    def _child(level: Level, parent: np.ndarray, back: bool) -> np.ndarray:
        """The first (with ``back``: last) child on ``level`` of letters of the level above."""
        if not back:
            return level.first[parent].astype(np.int64)
        return np.append(level.first, len(level.letters))[parent + 1].astype(np.int64) - 1

    @staticmethod
    def _common(level: Level, a: np.ndarray, b: np.ndarray, back: bool) -> np.ndarray:
        """How many equal letters to pass at once: what both blocks still hold, or one."""
        if not level.blocks:
            return np.ones(len(a), np.int64)
        ends = np.append(level.first, len(level.letters)).astype(np.int64)
        if back:
            return np.minimum(a - ends[level.parent[a]], b - ends[level.parent[b]]) + 1
        return np.minimum(ends[level.parent[a] + 1] - a, ends[level.parent[b] + 1] - b)
