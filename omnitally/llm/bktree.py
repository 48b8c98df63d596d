"""BK-trees over 64-bit fingerprints, many small trees at a time, as NumPy arrays.

A tree's children are keyed by their integer Hamming distance to the parent, and a search
follows only the edges within ``radius`` of the query's own distance to the parent.
"""

from __future__ import annotations

import numpy as np

EDGES = 65  # possible distances, 0 to 64
FRONTIER = 500_000  # (query, node) pairs held at once


def distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b).astype(np.int64)


def union(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Merge the sets of a[i] and b[i]; the smallest index labels a set."""
    labels = labels.copy()
    while True:
        la, lb = labels[a], labels[b]
        open_ = la != lb
        if not open_.any():
            return labels
        a, b, la, lb = a[open_], b[open_], la[open_], lb[open_]
        np.minimum.at(labels, np.maximum(la, lb), np.minimum(la, lb))
        while True:
            up = labels[labels]
            if (up == labels).all():
                break
            labels = up


class Forest:
    """One BK-tree for each distinct value of ``shard``."""

    def __init__(self, shard: np.ndarray, fp: np.ndarray):
        n = len(fp)
        self.fp, self.parent, self.edge = fp, np.full(n, -1), np.zeros(n, dtype=np.int64)
        self.root = np.zeros(n, dtype=np.int64)  # of each entry's tree
        self.levels, self.near = [], []
        members = np.argsort(shard, kind="stable")
        group = np.unique(shard[members], return_inverse=True)[1]
        top = True
        while len(members):
            first = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
            pivots = members[first]
            index = np.repeat(np.arange(len(first)), np.diff(np.r_[first, len(members)]))
            if top:
                self.root[members], top = pivots[index], False
            self.levels.append(pivots)
            rest = np.ones(len(members), dtype=bool)
            rest[first] = False
            members, index = members[rest], index[rest]
            d = distance(fp[members], fp[pivots[index]])
            order = np.argsort(index * EDGES + d, kind="stable")
            members, index, d = members[order], index[order], d[order]
            # Each entry's parent is overwritten until the entry itself becomes a pivot.
            self.parent[members], self.edge[members] = pivots[index], d
            self.near.append((members, pivots[index], d))
            group = index * EDGES + d
        kids = np.flatnonzero(self.parent >= 0)
        key = self.parent[kids] * EDGES + self.edge[kids]
        order = np.argsort(key, kind="stable")
        self.kids, self.kid_key = kids[order], key[order]

    def spread(self, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Smallest and largest label in the subtree of each node."""
        low, high = labels.copy(), labels.copy()
        for nodes in reversed(self.levels[1:]):
            np.minimum.at(low, self.parent[nodes], low[nodes])
            np.maximum.at(high, self.parent[nodes], high[nodes])
        return low, high

    def connect(self, radius: int) -> np.ndarray:
        """Label of every entry: the first entry that it reaches over links within ``radius``.

        Links seen while building are merged at once. The search then looks for links
        between different sets only, skipping subtrees that lie wholly in the query's set;
        pairs of one set need no look, so a dense group costs no square of its size.
        """
        labels = np.arange(len(self.fp))
        for child, pivot, d in self.near:
            hit = d <= radius
            labels = union(labels, child[hit], pivot[hit])
        low, high = self.spread(labels)
        queries = np.arange(len(self.fp))
        stack = [(queries, self.root)]
        while stack:
            q, node = stack.pop()
            if len(q) > FRONTIER:
                stack.append((q[FRONTIER:], node[FRONTIER:]))
                q, node = q[:FRONTIER], node[:FRONTIER]
            other = (low[node] != labels[q]) | (high[node] != labels[q])
            q, node = q[other], node[other]
            if not len(q):
                continue
            d = distance(self.fp[q], self.fp[node])
            hit = (d <= radius) & (labels[q] != labels[node])
            if hit.any():
                labels = union(labels, q[hit], node[hit])
                low, high = self.spread(labels)
            start = np.searchsorted(self.kid_key, node * EDGES + np.maximum(d - radius, 0))
            stop = np.searchsorted(self.kid_key, node * EDGES + np.minimum(d + radius, EDGES - 1), "right")
            width = stop - start
            offset = np.arange(width.sum()) - np.repeat(np.cumsum(width) - width, width)
            stack.append((np.repeat(q, width), self.kids[np.repeat(start, width) + offset]))
        return labels
