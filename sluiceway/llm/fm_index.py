"""An FM-index over a text of small integers, in numpy: build, backward search, locate."""

from __future__ import annotations

import numpy as np

SAMPLE = 16


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Order of all suffixes by prefix doubling; the end of the text sorts before every symbol."""
    n = len(text)
    rank = np.unique(text, return_inverse=True)[1].astype(np.int64)
    width = 1
    while True:
        after = np.zeros(n, np.int64)
        if width < n:
            after[:-width] = rank[width:] + 1
        key = rank * (n + 1) + after
        order = np.argsort(key, kind="stable")
        sorted_key = key[order]
        new = np.empty(n, np.int64)
        new[order] = np.concatenate(([0], np.cumsum(sorted_key[1:] != sorted_key[:-1])))
        rank = new
        if rank.max(initial=0) == n - 1 or width >= n:
            return order
        width *= 2


class FMIndex:
    """Symbols are 1 and above; 0 is put at the end of the text by the index itself."""

    def __init__(self, text: np.ndarray, n_symbols: int):
        text = np.concatenate((text.astype(np.int64), [0]))
        order = suffix_array(text)
        self.starts = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=n_symbols))))
        sampled = order % SAMPLE == 0
        self.sampled = sampled
        self.sampled_before = np.cumsum(sampled) - sampled
        self.samples = order[sampled]
        # Wavelet tree in matrix form: one bit plane per level, the symbols of a level sorted by its bits.
        rest = text[order - 1]
        self.levels = []
        for bit in reversed(range(max(1, int(n_symbols - 1).bit_length()))):
            ones = (rest >> bit) & 1
            before = np.concatenate(([0], np.cumsum(ones)))
            self.levels.append((bit, len(rest) - int(before[-1]), before))
            rest = np.concatenate((rest[ones == 0], rest[ones == 1]))

    def rank(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Occurrences of each symbol before each position of the transformed text."""
        begin, end = np.zeros(len(at), np.int64), at
        for bit, zeros, before in self.levels:
            one = (symbols >> bit) & 1 == 1
            begin = np.where(one, zeros + before[begin], begin - before[begin])
            end = np.where(one, zeros + before[end], end - before[end])
        return end - begin

    def symbol(self, at: np.ndarray) -> np.ndarray:
        """The symbols of the transformed text at the given positions."""
        value = np.zeros(len(at), np.int64)
        for bit, zeros, before in self.levels:
            one = before[at + 1] > before[at]
            value |= one.astype(np.int64) << bit
            at = np.where(one, zeros + before[at], at - before[at])
        return value

    def search(self, patterns: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row ranges [low, high) of right-aligned patterns, all searched backwards at once."""
        width = patterns.shape[1]
        low, high = np.zeros(len(patterns), np.int64), np.full(len(patterns), self.starts[-1])
        alive = np.arange(len(patterns))
        for step in range(width):
            alive = alive[(lengths[alive] > step) & (high[alive] > low[alive])]
            if not len(alive):
                break
            symbols = patterns[alive, width - 1 - step]
            low[alive] = self.starts[symbols] + self.rank(symbols, low[alive])
            high[alive] = self.starts[symbols] + self.rank(symbols, high[alive])
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of rows: step backwards through the text until a sampled suffix."""
        found = np.empty(len(rows), np.int64)
        left, at, steps = np.arange(len(rows)), rows, 0
        while len(left):
            hit = self.sampled[at]
            found[left[hit]] = self.samples[self.sampled_before[at[hit]]] + steps
            left, at = left[~hit], at[~hit]
            symbols = self.symbol(at)
            at = self.starts[symbols] + self.rank(symbols, at)
            steps += 1
        return found
