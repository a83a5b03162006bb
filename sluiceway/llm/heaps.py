"""Many bounded lists of best entries at once, in numpy."""

from __future__ import annotations

import numpy as np


class Heaps:
    """The first ``size`` entries of each of ``n`` lists: highest score first, equal scores by smaller key."""

    def __init__(self, n: int, size: int):
        self.scores = np.zeros((n, size), np.int64)
        self.keys = np.zeros((n, size), np.int64)
        self.filled = np.zeros(n, np.int64)

    def admits(self, at: np.ndarray, scores: np.ndarray, keys: np.ndarray) -> np.ndarray:
        """Which entries still have a place in the lists ``at``; the three broadcast against each other."""
        last, key = self.scores[at, -1], self.keys[at, -1]
        return (self.filled[at] < self.scores.shape[1]) | (scores > last) | ((scores == last) & (keys < key))

    def add(self, at: np.ndarray, scores: np.ndarray, keys: np.ndarray) -> None:
        """Put entries into the lists ``at``."""
        if not len(at):
            return
        touched = np.unique(at)
        old = np.repeat(touched, self.filled[touched])
        place = spread(np.zeros(len(touched), np.int64), self.filled[touched])
        at = np.concatenate((old, at))
        scores = np.concatenate((self.scores[old, place], scores))
        keys = np.concatenate((self.keys[old, place], keys))
        order = np.lexsort((keys, ~scores, at))
        at, scores, keys = at[order], scores[order], keys[order]
        first = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
        sizes = np.diff(np.concatenate((first, [len(at)])))
        rank = spread(np.zeros(len(first), np.int64), sizes)
        kept = rank < self.scores.shape[1]
        self.scores[at[kept], rank[kept]] = scores[kept]
        self.keys[at[kept], rank[kept]] = keys[kept]
        self.filled[at[first]] = np.minimum(sizes, self.scores.shape[1])

    def entries(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(list, score, key) of all entries."""
        at, place = np.nonzero(np.arange(self.scores.shape[1])[None, :] < self.filled[:, None])
        return at, self.scores[at, place], self.keys[at, place]


def spread(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of every run, one run after the other."""
    return np.arange(counts.sum()) + np.repeat(starts - np.cumsum(counts) + counts, counts)
