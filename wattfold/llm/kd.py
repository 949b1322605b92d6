"""K-d trees over small count vectors, searched by whole sets of queries at once."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np


class Tree:
    """Splits at medians of the widest-spread dimension; every node keeps its bounding box.

    The arrays describe nodes: ``dim`` (-1 at a leaf), ``cut`` (up to it goes left),
    ``kids``, ``leaf`` (a leaf's number) and the box ``lo``, ``hi``.
    """

    def __init__(self, points: np.ndarray, most: float):
        """Split until a leaf has at most ``most`` points, or points that are all alike."""
        self.dim, self.cut, self.kids, self.leaf, self.lo, self.hi = [], [], [], [], [], []
        self.members: list[np.ndarray] = []
        self._split(points, np.arange(len(points)), most)
        self.leaves = len(self.members)
        for name in ("dim", "cut", "leaf"):
            setattr(self, name, np.array(getattr(self, name), np.int64))
        self.kids = np.array(self.kids, np.int64).reshape(-1, 2)
        self.lo, self.hi = (np.array(x, np.int16).reshape(-1, points.shape[1]) for x in (self.lo, self.hi))

    def _split(self, points: np.ndarray, rows: np.ndarray, most: float) -> int:
        node = len(self.dim)
        here = points[rows]
        lo, hi = here.min(axis=0, initial=255), here.max(axis=0, initial=0)
        for held, x in ((self.dim, -1), (self.cut, 0), (self.kids, (-1, -1)), (self.leaf, -1), (self.lo, lo), (self.hi, hi)):
            held.append(x)
        spread = here.var(axis=0) if len(rows) > most else np.zeros(1)
        if spread.max() == 0:
            self.leaf[node] = len(self.members)
            self.members.append(rows)
            return node
        d = int(spread.argmax())
        cut = int(np.median(here[:, d]))
        cut = min(cut, int(hi[d]) - 1)
        left = here[:, d] <= cut
        self.dim[node], self.cut[node] = d, cut
        self.kids[node] = (self._split(points, rows[left], most), self._split(points, rows[~left], most))
        return node

    def homes(self, points: np.ndarray) -> np.ndarray:
        """The leaf whose side of every cut each point lies on."""
        out, todo = np.empty(len(points), np.int64), [(0, np.arange(len(points)))]
        while todo:
            node, rows = todo.pop()
            if self.dim[node] < 0:
                out[rows] = self.leaf[node]
            elif len(rows):
                left = points[rows, self.dim[node]] <= self.cut[node]
                todo += [(self.kids[node][0], rows[left]), (self.kids[node][1], rows[~left])]
        return out

    def fit_boxes(self, lo: dict[int, np.ndarray], hi: dict[int, np.ndarray]) -> None:
        """Set the boxes from those of the leaves' real contents; a leaf without any is never reached."""
        for node in range(len(self.dim) - 1, -1, -1):
            if self.dim[node] < 0:
                at = int(self.leaf[node])
                self.lo[node], self.hi[node] = lo.get(at, 255), hi.get(at, -255)
            else:
                a, b = self.kids[node]
                self.lo[node] = np.minimum(self.lo[a], self.lo[b])
                self.hi[node] = np.maximum(self.hi[a], self.hi[b])

    def reach(self, points: np.ndarray, radius: int) -> Iterator[tuple[int, np.ndarray]]:
        """Each leaf with the points whose L1 distance to its box is at most ``radius``."""
        todo = [(0, np.arange(len(points)))]
        while todo:
            node, rows = todo.pop()
            here = points[rows].astype(np.int16)
            off = np.maximum(self.lo[node] - here, 0) + np.maximum(here - self.hi[node], 0)
            rows = rows[off.sum(axis=1) <= radius]
            if not len(rows):
                continue
            if self.dim[node] < 0:
                yield int(self.leaf[node]), rows
            else:
                todo += [(int(kid), rows) for kid in self.kids[node]]


def thermometer(points: np.ndarray, tops: np.ndarray) -> np.ndarray:
    """Counts as bits, ``tops`` of them a dimension: dot products are then sums of minima."""
    return np.concatenate(
        [points[:, d : d + 1] > np.arange(top) for d, top in enumerate(tops) if top], axis=1
    ).astype(np.float32) if tops.any() else np.zeros((len(points), 1), np.float32)
