"""Packing token streams into windows by multiway differencing (operator 2)."""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattfold.llm import tokens
from wattfold.llm.common import TOKENIZER, stash

WINDOW = 1024  # tokens a sequence holds
GRAIN = 256  # what is left of a document after whole windows is cut into pieces of this length
BLOCK_WINDOWS = 256  # windows that are balanced together in one task


def differencing(sizes: np.ndarray, windows: int) -> tuple[np.ndarray, np.ndarray]:
    """Karmarkar-Karp: deal ``sizes`` to ``windows`` sets with near-equal sums.

    Every size starts as a partial partition with one filled set. The two partitions with
    the largest spreads are merged over and over, the fullest sets of one onto the emptiest
    of the other, so that their imbalances cancel. Returns the sums and each size's set.
    """
    n = len(sizes)
    heap = [(-int(s), i) for i, s in enumerate(sizes)]
    heapq.heapify(heap)
    sums: dict[int, np.ndarray] = {}
    merges: list[tuple[int, int, np.ndarray]] = []

    def slots(node: int) -> np.ndarray:
        if node >= n:
            return sums.pop(node)
        single = np.zeros(windows, np.int64)
        single[-1] = sizes[node]
        return single

    while len(heap) > 1:
        _, a = heapq.heappop(heap)
        _, b = heapq.heappop(heap)
        merged = slots(a) + slots(b)[::-1]
        order = merged.argsort(kind="stable")
        node = n + len(merges)
        sums[node] = merged = merged[order]
        merges.append((a, b, order))
        heapq.heappush(heap, (int(merged[0] - merged[-1]), node))
    final = slots(heap[0][1])
    # Undo the merges from the last: which window each slot of each partial became.
    at = {heap[0][1]: np.arange(windows)}
    for node in range(n + len(merges) - 1, n - 1, -1):
        a, b, order = merges[node - n]
        window = np.empty(windows, np.int64)
        window[order] = at.pop(node)
        at[a], at[b] = window, window[::-1]
    return final, np.array([at[i][-1] for i in range(n)])


def balanced_windows(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """Each size's window, in as few near-equal windows as hold at most ``capacity``.

    Starts from the least possible number and raises it while the fullest is too full.
    """
    total = int(sizes.sum())
    windows = max(1, -(-total // capacity))
    while True:
        sums, window = differencing(sizes, windows)
        over = int(sums.max()) - capacity
        if over <= 0:
            return window
        windows += max(1, windows * over // capacity // 2)


def cut(
    docs: DataFrame,
    tokenizer: str = TOKENIZER,
    window: int = WINDOW,
    grain: int = GRAIN,
    text_col: str = "text",
    end_id: int = 0,
) -> DataFrame:
    """Pieces of every document: its whole windows, then what is left in pieces of ``grain``.

    A document is the ids of its whole text (null: empty) and then ``end_id``. The other
    columns of ``docs`` repeat on each piece, with ``start``, ``length``, ``doc_tokens``
    and ``ids``, the piece's ids as little-endian unsigned 32-bit numbers.
    """
    made = {"start": "long", "length": "long", "doc_tokens": "long", "ids": "binary"}
    keep = [c for c in docs.columns if c != text_col and c not in made]
    schema = T.StructType([docs.schema[c] for c in keep])
    for name, kind in made.items():
        schema = schema.add(name, kind)
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("__text")

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokens.encoder(tokenizer)
        for batch in batches:
            row, start, length, total, ids = [], [], [], [], []
            for i, found in enumerate(encode(batch.column("__text").to_pylist())):
                stream = np.append(found, end_id).astype("<u4")
                n, at = len(stream), 0
                while at < n:
                    size = window if n - at >= window else min(grain, n - at)
                    row.append(i)
                    start.append(at)
                    length.append(size)
                    total.append(n)
                    ids.append(stream[at : at + size].tobytes())
                    at += size
            taken = batch.take(pa.array(row, pa.int64()))
            numbers = [pa.array(x, pa.int64()) for x in (start, length, total)]
            columns = [*(taken.column(c) for c in keep), *numbers, pa.array(ids, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=[*keep, *made])

    return docs.select(*[F.col(f"`{c}`") for c in keep], text).mapInArrow(pieces, schema)


def assign(pieces: DataFrame, window: int = WINDOW, block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``: where each piece lies.

    A piece as long as the window is a sequence. The others are dealt at random into blocks
    worth about ``block_windows`` windows; each block is balanced by itself in a task, so a
    task's work does not depend on the size of the corpus, and only the last fraction of
    a block's windows is padding. Rows are read twice, hence the stash.
    """
    pieces = stash(pieces.withColumn("__piece", F.monotonically_increasing_id()), "pieces")
    whole = pieces.where(F.col("length") >= window).select(
        "*", (F.col("__piece") * 2).alias("sequence_id"), F.lit(0).cast("bigint").alias("offset")
    )
    parts = pieces.where(F.col("length") < window)
    total = parts.agg(F.sum("length")).first()[0] or 0
    blocks = max(1, -(-total // (window * block_windows)))
    parts = parts.withColumn("__block", F.pmod(F.xxhash64("__piece"), F.lit(blocks)))
    schema = T.StructType(pieces.schema.fields).add("sequence_id", "long").add("offset", "long")

    def balance(block: pa.Table) -> pa.Table:
        block = block.sort_by("__piece")
        sizes = block["length"].to_numpy()
        in_window = balanced_windows(sizes, window)
        order = np.argsort(in_window, kind="stable")
        ends = np.cumsum(sizes[order])
        firsts = np.flatnonzero(np.diff(in_window[order], prepend=-1))
        before = np.repeat((ends - sizes[order])[firsts], np.diff(firsts, append=len(order)))
        offset = np.empty(len(order), np.int64)
        offset[order] = ends - sizes[order] - before
        sequence = (block["__block"].to_numpy() * 2**32 + in_window) * 2 + 1
        block = block.drop_columns(["__block"]).append_column("sequence_id", pa.array(sequence))
        return block.append_column("offset", pa.array(offset))

    placed = parts.groupBy("__block").applyInArrow(balance, schema)
    return whole.unionByName(placed).drop("__piece")


def pack(docs: DataFrame, **settings) -> DataFrame:
    """Every token of ``docs`` in sequences of at most 1024 tokens, as pieces with their ids.

    Empty tables give no pieces; an empty or null text is one piece holding the end id;
    repeated rows are packed each; extra columns repeat on the pieces (``start``,
    ``length``, ``doc_tokens``, ``ids``, ``sequence_id`` and ``offset`` are replaced).
    """
    return assign(cut(docs, **settings))


def digests(pieces: DataFrame) -> DataFrame:
    """``ids`` as their CRC, so that ids need not travel to the blocks."""
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
