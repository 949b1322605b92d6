"""Approximate nearest neighbours by collision counting (operator 5)."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from wattfold.llm import vectors as V

PROJECTIONS = 96  # sorted arrays of a shard
COLLISIONS = 0.7  # share of the windows that a vector must lie in to be verified
FIRST = 0.4  # half a window's first width, in standard deviations of the places
GROWTH = 1.1  # factor of one virtual rehashing
#: The search stops once half a window is so many times the k-th distance. On a random line two rows lie apart
#: by their distance times a normal draw, in any dimension; at 1.22 times a row collides on 78 % of the lines
#: on average, which is 1.65 standard deviations (of 96 draws) above the threshold.
STOP = 1.22
SEED = 7


class SortedProjections:
    """Each vector's place on random lines, one sorted array per line.

    The arrays lie end to end in one, shifted so that it is sorted throughout: one search
    finds a query's places on all lines.
    """

    def __init__(self, ids: np.ndarray, matrix: np.ndarray):
        self.ids, self.matrix = ids, matrix
        self.lines = np.random.default_rng(SEED).standard_normal((PROJECTIONS, matrix.shape[1]))
        places = (matrix @ self.lines.T).T
        self.order = np.argsort(places, axis=1, kind="stable")
        spread = float(np.median(places.std(axis=1)))
        reach = float(np.abs(places).max(initial=1.0))
        self.reach, self.first = reach, spread * FIRST or reach
        self.shift = np.arange(PROJECTIONS) * 8 * reach
        self.flat = (np.sort(places, axis=1, kind="stable") + self.shift[:, None]).ravel()

    def ask(self, query: int, vec: np.ndarray, k: int, kth) -> tuple[np.ndarray, np.ndarray]:
        """Widen the windows round the query's places until enough rows were verified.

        A virtual rehashing widens all windows by one factor; only what they newly cover
        is counted. Rows whose collisions reach the threshold are verified at once. The search
        stops when a row nearer than the k-th verified one (here or, by ``kth``, in another
        shard) would have collided by now, or when all windows cover everything.
        """
        n = len(self.ids)
        # Beyond the reach of the rows only the side matters, not how far.
        centre = np.clip(self.lines @ vec, -2 * self.reach, 2 * self.reach) + self.shift
        count, seen = np.zeros(n, np.int64), self.ids == query
        need = max(1, int(np.ceil(COLLISIONS * PROJECTIONS)))
        low = high = self.flat.searchsorted(centre)
        order, half = self.order.ravel(), self.first
        rows, dist = np.empty(0, np.int64), np.empty(0)
        while True:
            wide = min(half, 3.5 * self.reach)
            below = self.flat.searchsorted(centre - wide, "left")
            above = self.flat.searchsorted(centre + wide, "right")
            fresh = [order[a:b] for a, b in zip(below, low)] + [order[a:b] for a, b in zip(high, above)]
            count += np.bincount(np.concatenate(fresh), minlength=n)
            low, high = below, above
            new = np.flatnonzero((count >= need) & ~seen)
            seen[new] = True
            gap = self.matrix[new] - vec
            rows, dist = np.append(rows, new), np.append(dist, np.sqrt((gap * gap).sum(axis=1)))
            far = np.inf if kth is None else kth
            if len(dist) >= k:
                far = min(far, np.partition(dist, k - 1)[k - 1])
            if half >= STOP * far or (high - low).min() == n:
                return self.ids[rows], dist
            half *= GROWTH


def nearest(
    vectors: DataFrame, queries: DataFrame, k: int, id_col: str = "vec_id", vec_col: str = "embedding"
) -> DataFrame:
    """About the ``k`` nearest rows of each query by Euclidean distance: exact distances, high recall.

    Every row is indexed in the task that reads it: its projections on ``PROJECTIONS``
    random lines, each line a sorted array. A query opens a window round its own place on
    every line; widening the window stands for rehashing with wider buckets. Rows lying in
    ``COLLISIONS`` of the windows are verified on the original vectors. The lines do not
    depend on the data, so shards agree and a lost task repeats exactly.

    A row is no candidate for its own id. Null ids, null or zero vectors and vectors with
    null or non-finite components take no part; rows of another length are no candidates;
    repeated rows are candidates each; repeated queries are one; ties go to smaller ids.
    """
    rows = V.usable(vectors, id_col, vec_col, zero=False)
    asked = V.usable(queries, id_col, vec_col, zero=False).dropDuplicates(["vec_id"])
    return V.search(
        rows, asked, k, lambda ids, matrix: SortedProjections(ids, matrix).ask, "float64", largest=False
    )
