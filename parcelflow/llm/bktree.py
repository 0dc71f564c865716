"""BK-trees over binary fingerprints, built and searched level by level with numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: Pairs of (query, node) looked at in one step of a search; bounds its memory.
FRONTIER = 1 << 18


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hamming distances of fingerprints given as rows of 64-bit words."""
    return np.bitwise_count(a ^ b).sum(axis=1, dtype=np.int64)


class BKTree:
    """A node's children are keyed by their integer Hamming distance to it.

    By the triangle inequality, entries within `radius` of a query at distance d from a node lie
    below the edges d - radius to d + radius only.
    """

    def __init__(self, words: np.ndarray):
        self.words = words
        self.edge_base = 64 * words.shape[1] + 1
        n = len(words)
        parent = np.full(n, -1, dtype=np.int64)
        edge = np.zeros(n, dtype=np.int64)
        waiting = np.arange(1, n, dtype=np.int64)
        node = np.zeros(len(waiting), dtype=np.int64)
        while len(waiting):
            d = distances(words[waiting], words[node])
            slot = node * self.edge_base + d
            order = np.lexsort((waiting, slot))
            waiting, slot, node, d = waiting[order], slot[order], node[order], d[order]
            first = np.r_[True, slot[1:] != slot[:-1]]
            parent[waiting[first]], edge[waiting[first]] = node[first], d[first]
            heads = waiting[first][np.cumsum(first) - 1]
            waiting, node = waiting[~first], heads[~first]
        children = np.arange(1, n, dtype=np.int64)
        key = parent[1:] * self.edge_base + edge[1:]
        order = np.argsort(key, kind="stable")
        self.child_key, self.child = key[order], children[order]

    def within(self, queries: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs (query number, entry number) at most `radius` apart, in parts."""
        if not len(self.words):
            return
        numbers = np.arange(len(queries), dtype=np.int64)
        stack = [(numbers, np.zeros(len(numbers), dtype=np.int64))]
        while stack:
            asked, node = stack.pop()
            if len(asked) > FRONTIER:
                stack.append((asked[FRONTIER:], node[FRONTIER:]))
                asked, node = asked[:FRONTIER], node[:FRONTIER]
            d = distances(queries[asked], self.words[node])
            hit = d <= radius
            if hit.any():
                yield asked[hit], node[hit]
            base = node * self.edge_base
            low = np.searchsorted(self.child_key, base + np.maximum(d - radius, 0), "left")
            top = base + np.minimum(d + radius, self.edge_base - 1)
            count = np.searchsorted(self.child_key, top, "right") - low
            total = int(count.sum())
            if total:
                start = np.repeat(low - np.r_[0, np.cumsum(count)[:-1]], count)
                stack.append((np.repeat(asked, count), self.child[start + np.arange(total)]))


def merge_labels(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Bring both ends of every pair to one label, the smallest of their group, in place."""
    while True:
        la, lb = label[a], label[b]
        apart = la != lb
        if not apart.any():
            return
        a, b, la, lb = a[apart], b[apart], la[apart], lb[apart]
        low = np.minimum(la, lb)
        np.minimum.at(label, la, low)
        np.minimum.at(label, lb, low)
        while True:
            up = label[label]
            if np.array_equal(up, label):
                break
            label[:] = up
