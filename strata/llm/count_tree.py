"""An R-tree over count vectors: points are a text's shingle counts per hash group.

The counts of two texts bound their overlap: at most the sum over the groups of the
smaller count.  A tree node keeps the largest coordinate of its points, so the sum of
coordinate minima with it bounds the overlap with every point below.
"""

from __future__ import annotations

import numpy as np

LEAF, FANOUT = 16, 8
#: Queries that go down the tree together.
TOGETHER = 32


def needed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least intersection of sets of sizes a and b with 100 * intersection >= 80 * union."""
    return (4 * (a + b) + 8) // 9


class CountTree:
    """Packed bottom-up from points sorted by size, so nodes are narrow in size."""

    def __init__(self, vectors: np.ndarray, sizes: np.ndarray, labels: np.ndarray):
        order = np.lexsort((vectors[:, 0], labels, sizes))
        self.order = order
        self.vectors, self.sizes, self.labels = vectors[order], sizes[order], labels[order]
        self.levels: list[dict[str, np.ndarray]] = []
        high, small, large, label, width = self.vectors, self.sizes, self.sizes, self.labels, LEAF
        mixed = np.zeros(len(order), dtype=bool)
        while True:
            starts = np.arange(0, len(high), width)
            least, most = np.minimum.reduceat(label, starts), np.maximum.reduceat(label, starts)
            mixed = np.logical_or.reduceat(mixed, starts) | (least != most)
            high, label = np.maximum.reduceat(high, starts, axis=0), least
            small, large = np.minimum.reduceat(small, starts), np.maximum.reduceat(large, starts)
            self.levels.append({"high": high, "small": small, "large": large, "label": label, "mixed": mixed, "width": width})
            if len(high) == 1:
                break
            width = FANOUT

    def search(self, vectors: np.ndarray, sizes: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(query, point) pairs of different labels whose sizes and counts allow a link."""
        found: list[tuple[np.ndarray, np.ndarray]] = []
        for at in range(0, len(sizes), TOGETHER):
            v, n, own = vectors[at:at + TOGETHER], sizes[at:at + TOGETHER], labels[at:at + TOGETHER]
            q, node = np.arange(len(n)), np.zeros(len(n), dtype=np.int64)
            for i in range(len(self.levels) - 1, -1, -1):
                level = self.levels[i]
                floor = np.maximum(level["small"][node], (4 * n[q] + 4) // 5)
                keep = (5 * n[q] >= 4 * level["small"][node]) & (5 * level["large"][node] >= 4 * n[q])
                keep &= level["mixed"][node] | (level["label"][node] != own[q])
                q, node, floor = q[keep], node[keep], floor[keep]
                keep = np.minimum(v[q], level["high"][node]).sum(1, dtype=np.int64) >= needed(n[q], floor)
                q, node = q[keep], node[keep]
                below = len(self.levels[i - 1]["small"]) if i else len(self.sizes)
                first = node * level["width"]
                count = np.minimum(first + level["width"], below) - first
                q = np.repeat(q, count)
                node = np.repeat(first - np.cumsum(count) + count, count) + np.arange(int(count.sum()))
            keep = (5 * n[q] >= 4 * self.sizes[node]) & (5 * self.sizes[node] >= 4 * n[q]) & (self.labels[node] != own[q])
            q, node = q[keep], node[keep]
            keep = np.minimum(v[q], self.vectors[node]).sum(1, dtype=np.int64) >= needed(n[q], self.sizes[node])
            found.append((q[keep] + at, self.order[node[keep]]))
        return np.concatenate([x for x, _ in found]), np.concatenate([y for _, y in found])
