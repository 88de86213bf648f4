"""A run-length grammar of a sequence by recompression, and exact longest common extensions read off it.

Each level replaces every run of a symbol by one symbol for (symbol, times), and then every pair of neighbours whose first
symbol is a left one and whose second is a right one by one symbol for the pair. Equal places are thus cut alike, but for a symbol or so at
their ends, and equal symbols of a level stand for equal words. A symbol that occurs once in a level equals no other and is left out of the
levels above, so that text without repeats costs little more than one level.

`Extensions` keeps the symbols that begin (or end) at a place one after another by level. A query climbs while both places have equal
symbols, steps over them, a whole run at a time, and comes down where they differ: a few steps a level, so a logarithm in all.
All queries of a batch go in step.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np


@dataclass
class Level:
    """The symbols of a level in order: where each begins, how many words it stands for, and its run's symbols from it onward and up to it."""

    start: np.ndarray
    size: np.ndarray
    symbol: np.ndarray
    ahead: np.ndarray
    behind: np.ndarray


def _named(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A number for each different key, and how often the key of each place occurs."""
    _, names, times = np.unique(keys, return_inverse=True, return_counts=True)
    return names, times[names]


def _sides(symbol: np.ndarray, joined: np.ndarray, level: int) -> np.ndarray:
    """Places whose symbol pairs up with the next: left symbols before right ones, by a hash of the level; the better of both ways round."""
    mixed = (symbol.astype(np.uint64) + np.uint64(2 * level + 1)) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(29)
    left = ((mixed * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(40)) & np.uint64(1) == 1
    here, there = left[:-1] & ~left[1:] & joined, ~left[:-1] & left[1:] & joined
    pairs = here if here.sum() >= there.sum() else there
    if not pairs.any():  # the first neighbours' symbols alone, so that every level brings a pair
        at = np.flatnonzero(joined)[0]
        pairs = joined & (symbol[:-1] == symbol[at]) & (symbol[1:] == symbol[at + 1])
    return pairs


def levels(words: np.ndarray) -> Iterator[Level]:
    """The levels of the grammar of a sequence of numbers, from the words up, without symbols that occur once."""
    symbol, times = _named(words)
    start, size = np.arange(len(words)), np.ones(len(words), np.int64)
    level = 0
    while True:
        kept = times > 1
        start, size, symbol = start[kept], size[kept], symbol[kept]
        if not len(start):
            return
        n = len(start)
        same = (start[:-1] + size[:-1] == start[1:]) & (symbol[:-1] == symbol[1:])
        first = np.flatnonzero(np.concatenate([[True], ~same]))
        times = np.diff(np.append(first, n))
        into = np.arange(n) - np.repeat(first, times)
        yield Level(start, size, symbol, np.repeat(times, times) - into, into + 1)

        # Blocks: a run of several gets a symbol of its own.
        top = int(symbol.max()) + 1
        start, size, symbol = start[first], size[first] * times, symbol[first].astype(np.int64)
        runs = np.flatnonzero(times > 1)
        if len(runs):
            names, _ = _named(symbol[runs] * (int(times.max()) + 1) + times[runs])
            symbol[runs] = top + names
            top += int(names.max()) + 1
        # Pairs.
        joined = start[:-1] + size[:-1] == start[1:]
        if not joined.any() and not len(runs):
            return
        pairs = np.flatnonzero(_sides(symbol, joined, level)) if joined.any() else np.array([], np.int64)
        keys = symbol * (top + 1)
        keys[pairs] += symbol[pairs + 1] + 1
        size[pairs] += size[pairs + 1]
        rest = np.ones(len(start), bool)
        rest[pairs + 1] = False
        start, size = start[rest], size[rest]
        symbol, times = _named(keys[rest])
        level += 1


class Extensions:
    """Longest common extensions of a sequence, forward from two places or backward before them."""

    def __init__(self, n: int, grammar: list[Level], backward: bool = False):
        self.sign = -1 if backward else 1
        at = [x.start + x.size if backward else x.start for x in grammar]
        self.height = np.zeros(n + 1, np.int64)
        for x in at:
            self.height[x] += 1
        self.first = np.concatenate([[0], np.cumsum(self.height)[:-1]])
        total = int(self.height.sum()) + 1
        self.symbol, self.size, self.run = (np.zeros(total, np.int64) for _ in range(3))
        for k, (x, level) in enumerate(zip(at, grammar, strict=True)):
            place = self.first[x] + k
            self.symbol[place], self.size[place] = level.symbol, level.size
            self.run[place] = level.behind if backward else level.ahead

    def of(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """How many words agree from x and y on (backward: before them)."""
        got = np.zeros(len(x), np.int64)
        left, level = np.arange(len(x)), np.zeros(len(x), np.int64)
        x, y = x.copy(), y.copy()
        while len(left):
            level = np.minimum(level, np.minimum(self.height[x], self.height[y]) - 1)
            low = np.maximum(level, 0)
            i, j = self.first[x] + low, self.first[y] + low
            equal = (level >= 0) & (self.symbol[i] == self.symbol[j])
            step = np.where(equal, np.minimum(self.run[i], self.run[j]) * self.size[i], 0)
            got[left] += step
            x += self.sign * step
            y += self.sign * step
            level = np.where(equal, level + 1, level - 1)
            more = level >= 0
            if not more.all():
                left, x, y, level = left[more], x[more], y[more], level[more]
        return got
