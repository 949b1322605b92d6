"""Exact top-k by inner product with MaxScore over component postings (operator 7)."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattfold.llm import vectors as V

FIRST = 2048  # rows that are scored in full where no threshold is known yet


class Postings:
    """The non-zero entries of each component of a shard, and the largest and smallest value."""

    def __init__(self, ids: np.ndarray, matrix: np.ndarray):
        self.ids, self.n = ids, len(ids)
        columns = np.ascontiguousarray(matrix.T).astype(np.int64)
        self.rows, self.values, self.high, self.low = [], [], [], []
        for column in columns:
            rows = np.flatnonzero(column)
            whole = len(rows) == self.n
            self.rows.append(slice(None) if whole else rows)
            self.values.append(column)
            self.high.append(int(column.max(initial=0)))
            self.low.append(int(column.min(initial=0)))

    def ask(self, query: int, vec: np.ndarray, k: int, kth) -> tuple[np.ndarray, np.ndarray]:
        weights = vec.astype(np.int64).tolist()
        bounds = [max(w * h, w * l) for w, h, l in zip(weights, self.high, self.low)]
        terms = [t for t in np.argsort(bounds, kind="stable")[::-1].tolist() if weights[t]]
        if kth is None and self.n > FIRST:
            # A threshold from the first rows, scored over all terms.
            score = sum((weights[t] * self.values[t][:FIRST] for t in terms), np.zeros(FIRST, np.int64))
            score = score[self.ids[:FIRST] != query]
            kth = np.partition(score, -k)[-k] if len(score) >= k else None
        # Non-essential: the weakest terms, which together stay below the threshold.
        after = np.append(np.cumsum([bounds[t] for t in terms][::-1])[::-1], 0).astype(np.int64)
        essential = len(terms)
        while kth is not None and essential and after[essential - 1] < kth:
            essential -= 1
        score = np.zeros(self.n, np.int64)
        for t in terms[:essential]:
            rows = self.rows[t]
            score[rows] += weights[t] * self.values[t][rows]
        own = self.ids == query
        alive = np.flatnonzero(~own if kth is None else ~own & (score + after[essential] >= kth))
        score = score[alive]
        # Probe the others, strongest first, while a row can still reach the threshold.
        for i, t in enumerate(terms[essential:], essential + 1):
            score = score + weights[t] * self.values[t][alive]
            if kth is not None:
                fit = score + after[i] >= kth
                alive, score = alive[fit], score[fit]
        if len(score) > k:
            fit = score >= np.partition(score, -k)[-k]
            alive, score = alive[fit], score[fit]
        return self.ids[alive], score


def top_products(
    vectors: DataFrame, queries: DataFrame, k: int, id_col: str = "vec_id", vec_col: str = "vec"
) -> DataFrame:
    """The ``k`` rows with the largest inner product for each query, exactly.

    Vectors hold whole numbers and act as documents, their components as terms with
    signed impacts. A task keeps a posting list per component with the bounds of its
    values. Per query, components are split by the most they can add: those that even
    together cannot reach the k-th best score so far are non-essential and only probed for
    rows whose score over the essential ones stays competitive. Ties are kept, since a
    smaller id may win them. Shards' best rows are then merged.

    A row is no candidate for its own id. Null ids or vectors and vectors with null or
    non-finite components take no part; rows of another length than the query are no
    candidates for it; repeated rows are candidates each; repeated queries are one.
    """
    rows = V.usable(vectors, id_col, vec_col, zero=True)
    asked = V.usable(queries, id_col, vec_col, zero=True).dropDuplicates(["vec_id"])
    return V.search(
        rows, asked, k, lambda ids, matrix: Postings(ids, matrix).ask, "int64", largest=True
    )


def quantised(embeddings: DataFrame, levels: int = 256) -> DataFrame:
    """``vec_id`` and ``vec``: each component as ``floor(levels * x)`` in doubles.

    Vectors that take no part are left out first, since floor gives whole numbers for
    NaN and infinity too.
    """
    return V.usable(embeddings, "vec_id", "embedding", zero=True).select(
        "vec_id",
        F.transform("vec", lambda x: F.floor(x * levels).cast("double")).alias("vec"),
    )
