"""Searching a stated set of query vectors against every vector, shard by shard."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SHARD = 16384  # vectors that a task indexes at a time
QUERY_BLOCK = 8192  # queries that are broadcast at a time, about

FOUND = "query_id bigint, vec_id bigint, score {}"


def usable(vectors: DataFrame, id_col: str, vec_col: str, zero: bool) -> DataFrame:
    """``vec_id`` and ``vec`` (doubles) of the rows that take part.

    Out are null ids, null vectors, and vectors with null or non-finite components;
    without ``zero`` also those with nothing but zeros.
    """
    rows = vectors.select(
        F.col(f"`{id_col}`").cast("bigint").alias("vec_id"),
        F.col(f"`{vec_col}`").cast("array<double>").alias("vec"),
    )
    odd = F.exists(
        "vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))
    )
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("vec").isNotNull() & ~odd)
    return rows if zero else rows.where(F.exists("vec", lambda x: x != 0))


def search(
    vectors: DataFrame,
    queries: DataFrame,
    k: int,
    index: Callable[[np.ndarray, np.ndarray], Callable],
    score_type: str,
    largest: bool,
) -> DataFrame:
    """Each query's ``k`` best rows: ``query_id, rank, vec_id, score``, ties to smaller ids.

    ``index(ids, matrix)`` builds a shard's index and returns a function from (query id,
    query vector, ``k``, the k-th best score so far or None) to found ids and scores. Every
    task indexes the vectors it reads, shard by shard, and answers all queries of a block on
    them; what is shuffled is at most ``k`` rows a query and task. Queries are broadcast in
    blocks of about ``QUERY_BLOCK``, so no broadcast grows with the table.
    """
    sc = vectors.sparkSession.sparkContext
    blocks = max(1, -(-queries.count() // QUERY_BLOCK))
    sign = -1 if largest else 1
    parts = []
    for block in range(blocks):
        rows = queries.where(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == block)
        asked = sc.broadcast([(r[0], np.array(r[1], np.float64)) for r in rows.select("vec_id", "vec").collect()])

        def answer(batches: Iterator[pd.DataFrame], asked=asked) -> Iterator[pd.DataFrame]:
            best = [(np.empty(0, np.int64), np.empty(0, score_type)) for _ in asked.value]
            for ids, vecs in _shards(batches):
                for matrix, own in _by_length(ids, vecs):
                    ask = index(own, matrix)
                    for i, (query, vec) in enumerate(asked.value):
                        if len(vec) != matrix.shape[1]:
                            continue
                        had_ids, had = best[i]
                        new_ids, new = ask(query, vec, k, had[-1] if len(had) == k else None)
                        both, scores = np.append(had_ids, new_ids), np.append(had, new)
                        top = np.lexsort((both, sign * scores))[:k]
                        best[i] = both[top], scores[top]
            for (query, _), (ids, scores) in zip(asked.value, best):
                if len(ids):
                    yield pd.DataFrame({"query_id": query, "vec_id": ids, "score": scores})

        kind = "bigint" if score_type == "int64" else "double"
        parts.append(vectors.select("vec_id", "vec").mapInPandas(answer, FOUND.format(kind)))
    found = parts[0]
    for part in parts[1:]:
        found = found.union(part)
    score = F.desc("score") if largest else F.asc("score")
    order = Window.partitionBy("query_id").orderBy(score, "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _shards(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[np.ndarray, list]]:
    held, rows = [], 0
    for pdf in batches:
        held.append(pdf)
        rows += len(pdf)
        if rows >= SHARD:
            yield _joined(held)
            held, rows = [], 0
    if rows:
        yield _joined(held)


def _joined(held: list[pd.DataFrame]) -> tuple[np.ndarray, list]:
    pdf = pd.concat(held, ignore_index=True)
    return pdf["vec_id"].to_numpy(np.int64), pdf["vec"].tolist()


def _by_length(ids: np.ndarray, vecs: list) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    lengths = np.array([len(v) for v in vecs])
    for n in np.unique(lengths):
        at = np.flatnonzero(lengths == n)
        yield np.stack([np.asarray(vecs[i], np.float64) for i in at]), ids[at]
