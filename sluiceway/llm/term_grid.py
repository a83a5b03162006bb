"""A K2-treap over a grid of terms and documents, and the best documents of several terms by joint descent.

The grid is cut into four again and again. Every cell that is not empty has a node with the largest impact inside; children are
found by counting bits in a bitmap of four bits a node, and a node's largest impact is stored as what it lacks of its parent's.
"""

from __future__ import annotations

import numpy as np

from sluiceway.llm.heaps import Heaps, spread

#: Document ranges of one item that are opened at a time.
OPENED = 48


class K2Treap:
    """``rows``, ``columns`` and positive ``impacts`` of the points, at most one a cell."""

    def __init__(self, rows: np.ndarray, columns: np.ndarray, impacts: np.ndarray, n_rows: int, n_columns: int):
        self.depth = max(1, int(max(n_rows, n_columns) - 1).bit_length())
        code = np.zeros(len(rows), np.int64)
        for bit in range(self.depth):
            code |= ((rows >> bit & 1) << 1 | (columns >> bit & 1)) << (2 * bit)
        order = np.argsort(code)
        code, most = code[order], impacts[order]
        bits, lacks = [], []
        for _ in range(self.depth):
            parent = code >> 2
            first = np.flatnonzero(np.concatenate(([True], parent[1:] != parent[:-1])))
            above = np.maximum.reduceat(most, first)
            number = np.cumsum(np.concatenate(([0], parent[1:] != parent[:-1])))
            bits.append(4 * number + (code & 3))
            lacks.append(above[number] - most)
            code, most = parent[first], above
        self.most = int(most[0])
        # Nodes are numbered from the root, level by level; the bits of a level start where those of the one above end.
        places, start, nodes = [], 0, 1
        for level in reversed(bits):
            places.append(level + start)
            start += 4 * nodes
            nodes = len(level)
        at = np.concatenate(places)
        bitmap = np.zeros(start // 64 + 1, np.uint64)
        np.bitwise_or.at(bitmap, at >> 6, np.uint64(1) << (at & 63).astype(np.uint64))
        self.bitmap = bitmap
        self.before = np.cumsum(np.bitwise_count(bitmap), dtype=np.int64) - np.bitwise_count(bitmap)
        lack = np.concatenate([[0], *reversed(lacks)])
        self.lack = lack.astype(np.uint32) if lack.max() < 1 << 32 else lack.astype(np.uint64)

    def children(self, nodes: np.ndarray, quadrants: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(whether there is a child, its number) of each node in a quadrant, 2 * row half + column half."""
        at = 4 * nodes + quadrants
        word, bit = self.bitmap[at >> 6], (at & 63).astype(np.uint64)
        there = (word >> bit & np.uint64(1)).astype(bool)
        below = np.bitwise_count(word & ((np.uint64(1) << bit) - np.uint64(1)))
        return there, self.before[at >> 6] + below + 1

    def best(self, terms: list[np.ndarray], keys: np.ndarray, heaps: Heaps, lists: np.ndarray) -> None:
        """Put the best columns of every item into its heap, scores being the sums of the impacts in the item's rows.

        ``terms`` are the rows of the items, ``keys`` the ascending keys of the columns, ``lists`` the items' places in
        ``heaps``. The paths of all rows of an item go down together over one range of columns, the range with the largest
        sum of maxima first; a range that cannot enter the heap is given up.
        """
        count = np.array([len(t) for t in terms], np.int64)
        item = np.flatnonzero(count)
        count = count[item]
        if not len(item):
            return
        row = np.concatenate(terms)
        node, most = np.zeros(len(row), np.int64), np.full(len(row), self.most)
        level, column = np.zeros(len(item), np.int64), np.zeros(len(item), np.int64)
        bound = count * self.most
        while len(item):
            start = np.cumsum(count) - count
            open_ = heaps.admits(lists[item], bound, keys[column << (self.depth - level)])
            order = np.lexsort((-bound, ~open_, item))
            first = np.flatnonzero(np.concatenate(([True], item[order][1:] != item[order][:-1])))
            rank = np.empty(len(item), np.int64)
            rank[order] = spread(np.zeros(len(first), np.int64), np.diff(np.concatenate((first, [len(item)]))))
            chosen, rest = np.flatnonzero(open_ & (rank < OPENED)), np.flatnonzero(open_ & (rank >= OPENED))
            path = spread(start[chosen], count[chosen])
            of = np.repeat(np.arange(len(chosen)), count[chosen])
            down = self.depth - 1 - level[chosen]
            half = (row[path] >> down[of] & 1) << 1
            parts = [(item[rest], level[rest], column[rest], bound[rest], count[rest], *(x[spread(start[rest], count[rest])] for x in (row, node, most)))]
            for side in (0, 1):
                there, child = self.children(node[path], half + side)
                kept, child = path[there], child[there]
                lower = most[kept] - self.lack[child].astype(np.int64)
                n = np.bincount(of[there], minlength=len(chosen))
                ends = np.cumsum(n)
                sums = np.concatenate(([0], np.cumsum(lower)))
                total = sums[ends] - sums[ends - n]
                where = column[chosen] * 2 + side
                leaf = (down == 0) & (n > 0)
                at = lists[item[chosen[leaf]]]
                fits = heaps.admits(at, total[leaf], keys[where[leaf]])
                heaps.add(at[fits], total[leaf][fits], keys[where[leaf]][fits])
                inner = np.flatnonzero((down > 0) & (n > 0))
                own = spread((ends - n)[inner], n[inner])
                parts.append((item[chosen[inner]], level[chosen[inner]] + 1, where[inner], total[inner], n[inner], row[kept][own], child[own], lower[own]))
            item, level, column, bound, count, row, node, most = (np.concatenate(x) for x in zip(*parts))
