"""Repeated word passages by suffix automata of reference shards.

The documents themselves are the reference. A shard holds the passages over one anchor in all documents
that contain it (see ``repeats``), in order of their keys. It is streamed: each document's segments run through
the shard's suffix automaton for their matching statistics, the length of the longest reference string that
ends at each word, and only then join it. Wherever the length reaches the threshold, the words back to the
threshold are covered; the spans of a document are merged in the end.

An automaton is built in the task that holds its shard instead of being broadcast: with every document as
reference and as query, each broadcast shard would have to meet every document.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from sluiceway.llm import repeats

WIDTH = 13


class SuffixAutomaton:
    """All substrings of the sequences added so far."""

    __slots__ = ("following", "link", "length")

    def __init__(self):
        self.following: list[dict] = [{}]
        self.link = [-1]
        self.length = [0]

    def _state(self, length: int, link: int, following: dict) -> int:
        self.length.append(length)
        self.link.append(link)
        self.following.append(following)
        return len(self.length) - 1

    def _reached(self, state: int, symbol) -> int:
        """The state for one more symbol after ``state``, which has that transition; split off if it holds longer strings."""
        target = self.following[state][symbol]
        if self.length[target] == self.length[state] + 1:
            return target
        copy = self._state(self.length[state] + 1, self.link[target], dict(self.following[target]))
        self.link[target] = copy
        while state >= 0 and self.following[state].get(symbol) == target:
            self.following[state][symbol] = copy
            state = self.link[state]
        return copy

    def add(self, sequence: list) -> None:
        last = 0
        for symbol in sequence:
            if symbol in self.following[last]:
                last = self._reached(last, symbol)
                continue
            new = self._state(self.length[last] + 1, 0, {})
            state = last
            while state >= 0 and symbol not in self.following[state]:
                self.following[state][symbol] = new
                state = self.link[state]
            if state >= 0:
                self.link[new] = self._reached(state, symbol)
            last = new

    def covered(self, sequence: list, threshold: int) -> list[tuple[int, int]]:
        """Merged spans of the sequence that matches of at least ``threshold`` symbols cover."""
        spans: list[list[int]] = []
        state, matched = 0, 0
        for i, symbol in enumerate(sequence, start=1):
            while state and symbol not in self.following[state]:
                state = self.link[state]
                matched = self.length[state]
            if symbol in self.following[state]:
                state = self.following[state][symbol]
                matched += 1
            if matched >= threshold:
                begin = i - matched
                if spans and begin <= spans[-1][1]:
                    spans[-1] = [min(begin, spans[-1][0]), i]
                else:
                    spans.append([begin, i])
        return [(b, e) for b, e in spans]


def _match(width: int) -> repeats.Match:
    def match(anchors: np.ndarray, keys: np.ndarray, segments: list[bytes]):
        rows, begins, ends = [], [], []
        at, n = 0, len(segments)
        while at < n:
            until = at + int(np.searchsorted(anchors[at:], anchors[at], side="right"))
            automaton, held = SuffixAutomaton(), set()
            while at < until:
                document = at
                while at < until and keys[at] == keys[document]:
                    at += 1
                for row in range(document, at):
                    ws = segments[row].split(b" ")
                    # A segment that was added as it is matches as a whole.
                    spans = [(0, len(ws))] if segments[row] in held and len(ws) >= width else automaton.covered(ws, width)
                    for begin, end in spans:
                        rows.append(row)
                        begins.append(begin)
                        ends.append(end)
                if at < until:
                    for row in range(document, at):
                        if segments[row] not in held:
                            held.add(segments[row])
                            automaton.add(segments[row].split(b" "))
        return np.array(rows, np.int64), np.array(begins, np.int64), np.array(ends, np.int64)

    return match


def _codes(words: list[bytes]) -> np.ndarray:
    import xxhash

    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def remove_repeats(docs: DataFrame, width: int = WIDTH, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Cut words out of each document that a window of ``width`` words, also starting in a smaller document, covers.

    Returns ``key, n_units, n_removed, spans, kept, kept_sha256``: words, removed words, their ranges, the kept
    words joined by one space (bytes), and its digest. Words are runs of anything but ASCII white space. Null
    and empty texts have no words, texts below ``width`` words lose none. Keys are integers; a row with a null
    key keeps everything and is no reference; rows with one key do not remove each other's words. Other columns
    are ignored. Windows are judged on the input.
    """
    units = repeats.Units(width, (width + 1) // 2, lambda text: text.split(), _codes, b" ".join)
    return repeats.remove(docs, units, _match(width), key, text)
