"""Repeated byte strings by suffix arrays, sorted with a difference cover.

Shared passages are dealt to shards (see ``repeats``), so equal strings of the wanted length meet in one shard. A shard sorts all its suffixes: the sampled ones, at two of three positions, by their
triples; if triples repeat, their names form a text two thirds as long that is sorted in the same way; the
remaining suffixes follow from the order of the sampled ones, and both are merged. In the sorted order equal
prefixes are neighbours: runs of suffixes that agree in ``length`` bytes with their predecessor are one
string, and the least key of a run is the document that keeps it.

Sorting runs shard by shard and not over one text of the whole corpus: the triples of all positions of the
corpus would be shuffled once per level of the recursion, many times the input.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from sluiceway.llm import repeats

LENGTH = 50


def _names(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, names): the order of the keys and, by position, their rank from 1 with equal keys alike."""
    order = np.argsort(keys)
    ranked = keys[order]
    names = np.empty(len(keys), np.int64)
    names[order] = np.cumsum(np.concatenate(([1], ranked[1:] != ranked[:-1])))
    return order, names


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Sorted suffixes of a text of positive integers up to its length or 2**20, for texts below 2**31."""
    n = len(text)
    if n < 3:
        return np.array(sorted(range(n), key=lambda i: text[i:].tolist()), np.int64)
    s = np.concatenate((text.astype(np.int64), [0, 0, 0]))
    top = int(s.max()) + 1
    # With n = 1 modulo 3 the sample gets the empty suffix too, so that its first half ends with a name of its own.
    ones, twos, zeros = np.arange(1, n + (n % 3 == 1), 3), np.arange(2, n, 3), np.arange(0, n, 3)
    sample = np.concatenate((ones, twos))
    pair = s[:-1] * top + s[1:]
    if top >= 1 << 20:  # three symbols would not fit 63 bits
        pair = _names(pair)[1]
    order, names = _names(pair[sample] * top + s[sample + 2])
    if names[order[-1]] < len(sample):
        order = suffix_array(names)
    rank = np.zeros(n + 3, np.int64)  # from 1 in the order of the sample; 0 beyond the end
    rank[sample[order]] = np.arange(1, len(sample) + 1)
    rank[n:] = 0
    base = n + 3
    zeros = zeros[np.argsort(s[zeros] * base + rank[zeros + 1])]
    sampled = sample[order]
    sampled = sampled[sampled < n]
    one, two = sampled[sampled % 3 == 1], sampled[sampled % 3 == 2]
    # How many sampled suffixes precede each remaining one, by keys that compare both kinds.
    before = np.searchsorted(s[one] * base + rank[one + 1], s[zeros] * base + rank[zeros + 1])
    before += np.searchsorted(
        pair[two] * base + rank[two + 2], pair[zeros] * base + rank[zeros + 2]
    )
    out = np.empty(n, np.int64)
    place = before + np.arange(len(zeros))
    free = np.ones(n, bool)
    free[place] = False
    out[place] = zeros
    out[free] = sampled
    return out


def repeated_windows(
    segments: list[bytes], sizes: np.ndarray, owners: np.ndarray, length: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(segment, begin, end), in order, of the runs of windows that a segment of a smaller owner holds too."""
    nothing = (np.zeros(0, np.int64),) * 3
    starts = np.concatenate(([0], np.cumsum(sizes + 1)[:-1]))
    raw = np.frombuffer(b"\x00".join(segments) + b"\x00" * (length + 9), np.uint8)
    n = int((sizes + 1).sum())
    text = raw[:n].astype(np.int64) + 2
    text[starts + sizes] = 1  # between segments
    row = np.repeat(np.arange(len(segments)), sizes + 1)
    room = (starts + sizes)[row] - np.arange(n)
    order = suffix_array(text)
    order = order[room[order] >= length]  # starts of whole windows
    if len(order) < 2:
        return nothing
    eights = np.lib.stride_tricks.as_strided(raw, (len(raw) - 7, 8), (1, 1))
    words = np.ascontiguousarray(eights).view(np.int64).ravel()
    alike = np.ones(len(order) - 1, bool)
    for at in [*range(0, length - 7, 8), length - 8]:
        part = words[order + at]
        alike &= part[1:] == part[:-1]
    first = np.concatenate(([True], ~alike))
    owner = owners[row[order]]
    least = np.minimum.reduceat(owner, np.flatnonzero(first))[np.cumsum(first) - 1]
    hits = np.sort(order[least < owner])
    if not len(hits):
        return nothing
    new = np.flatnonzero(np.concatenate(([True], (np.diff(hits) > 1) | (np.diff(row[hits]) != 0))))
    last = np.concatenate((new[1:], [len(hits)])) - 1
    of = row[hits[new]]
    return of, hits[new] - starts[of], hits[last] - starts[of] + length


def _match(length: int) -> repeats.Match:
    def match(anchors: np.ndarray, keys: np.ndarray, segments: list[bytes]):
        # Equal segments are sorted once, for the least of their keys; in the others all windows are repeats. Equal ones have
        # equal windows, and so equal anchors.
        seen: dict[bytes, int] = {}
        which = np.array([seen.setdefault(x, len(seen)) for x in segments], np.int64)
        distinct = list(seen)
        n = len(distinct)
        owners = np.full(n, np.iinfo(np.int64).max)
        np.minimum.at(owners, which, keys)
        sizes = np.array([len(x) for x in distinct], np.int64)
        later = np.flatnonzero(keys > owners[which])
        of, begin, end = repeated_windows(distinct, sizes, owners, length)
        first = np.flatnonzero(keys == owners[which])
        times = np.bincount(of, minlength=n)
        at = np.cumsum(times) - times
        each = times[which[first]]
        span = np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each) + np.repeat(at[which[first]], each)
        return (
            np.concatenate((np.repeat(first, each), later)),
            np.concatenate((begin[span], np.zeros(len(later), np.int64))),
            np.concatenate((end[span], sizes[which[later]])),
        )

    return match


def _codes(text: bytes) -> np.ndarray:
    return np.frombuffer(text, np.uint8).astype(np.uint64) + np.uint64(1)


def remove_repeats(docs: DataFrame, length: int = LENGTH, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Cut bytes out of each document that a string of ``length`` bytes, also starting in a smaller document, covers.

    Returns ``key, n_units, n_removed, spans, kept, kept_sha256``: bytes, removed bytes, the maximal removed
    runs, the remaining bytes and their digest; what remains need not be valid UTF-8. ``length`` is 16 or more.
    Null and empty texts have no bytes, texts below ``length`` bytes lose none. Keys are integers; a row with a
    null key keeps everything and is no reference; rows with one key do not remove each other's bytes. Other
    columns are ignored. Strings are judged on the input.
    """
    gram = max(8, length // 3)
    units = repeats.Units(length, gram, lambda text: text, _codes, bytes, sides=True)
    return repeats.remove(docs, units, _match(length), key, text)
