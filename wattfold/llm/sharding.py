"""Sharding by best-fit-decreasing bin packing (operator 4)."""

from __future__ import annotations

from collections import defaultdict

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattfold.llm.common import dense_order, stash, text_digest

PARCELS = 4096  # what a shard set is dealt in: parcels of total / PARCELS bytes, or one larger group
LANE_GROUPS = 20000  # groups one task packs into parcels, as long as there are at most PARCELS lanes


class CapacityTree:
    """Bins by remaining capacity in a balanced binary tree over the capacity's bits.

    Level ``d`` counts the capacities below each node of width ``2 ** d``; finding the
    smallest capacity not under a size climbs and descends at most ``depth`` levels.
    """

    def __init__(self, largest: int):
        self.depth = max(1, int(largest).bit_length())
        self.levels = [defaultdict(int) for _ in range(self.depth + 1)]
        self.bins: dict[int, list[int]] = defaultdict(list)

    def add(self, capacity: int, label: int) -> None:
        self.bins[capacity].append(label)
        for d, level in enumerate(self.levels):
            level[capacity >> d] += 1

    def take_tightest(self, size: int) -> tuple[int, int] | None:
        """Remove and return (capacity, bin) with the least capacity that holds ``size``."""
        node, d = size, 0
        if not self.levels[0].get(node):
            while d <= self.depth and not (node % 2 == 0 and self.levels[d].get(node + 1)):
                node, d = node >> 1, d + 1
            if d > self.depth:
                return None
            node += 1
            while d:
                node, d = node * 2, d - 1
                if not self.levels[d].get(node):
                    node += 1
        label = self.bins[node].pop()
        for d, level in enumerate(self.levels):
            level[node >> d] -= 1
        return node, label


def best_fit(sizes: list[int], capacity: int, bins: int | None = None) -> list[int] | None:
    """Best-fit-decreasing: each size's bin; None if more than ``bins`` would be needed.

    A size above the capacity gets a bin of its own.
    """
    tree, used, out = CapacityTree(capacity), 0, [0] * len(sizes)
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        size = sizes[i]
        found = tree.take_tightest(size) if size <= capacity else None
        if found is None:
            if bins is not None and (used == bins or size > capacity):
                return None
            found, used = (max(capacity, size), used), used + 1
        if found[0] > size:
            tree.add(found[0] - size, found[1])
        out[i] = found[1]
    return out


def even_bins(sizes: list[int], bins: int) -> list[int]:
    """``sizes`` into exactly ``bins`` bins of the least capacity at which best fit succeeds.

    A size above the mean of what is left fills a bin alone; the others share the rest.
    """
    order = sorted(range(len(sizes)), key=lambda i: -sizes[i])
    out, total, first = [0] * len(sizes), sum(sizes), 0
    while first < len(order) and first < bins - 1 and sizes[order[first]] * (bins - first) >= total:
        out[order[first]] = first
        total -= sizes[order[first]]
        first += 1
    rest, left, slack = order[first:], bins - first, 0
    while rest:
        placed = best_fit([sizes[i] for i in rest], -(-total // left) + slack, left)
        if placed is not None:
            for i, b in zip(rest, placed):
                out[i] = first + b
            break
        slack = slack * 2 or 1
    return out


def shard(docs: DataFrame, shards: int, text_col: str = "text") -> DataFrame:
    """``docs`` with ``size``, ``text_crc32``, ``shard`` and ``slot``; equal texts stay together.

    Groups of equal texts are found by digest with map-side sums, so a hot text is one row
    per task. They are packed in two levels: tasks pack the groups of a hash lane
    into parcels of at most a few thousandths of the total, each by best fit over a capacity tree;
    the parcels, at most ``3 * PARCELS`` whatever the corpus, are then packed into the
    shards at the least capacity that holds them. Rows find their shard by digest and are
    numbered cell by cell, so no task holds a shard.

    A null text has no bytes and is grouped with the empty text; ``size`` is one more than
    the bytes. Repeated rows are kept. Empty tables give an empty result. ``size``,
    ``text_crc32``, ``shard`` and ``slot`` replace columns of the same names.
    """
    spark = docs.sparkSession
    made = ("size", "text_crc32", "shard", "slot")
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    rows = stash(
        docs.select(
            *[F.col(f"`{c}`") for c in docs.columns if c != text_col and c not in made],
            (F.octet_length(text) + 1).cast("bigint").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            text_digest(text).alias("__digest"),
        ),
        "shard-rows",
    )
    groups = stash(rows.groupBy("__digest").agg(F.sum("size").alias("size")), "shard-groups")
    total, n = groups.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count("*")).first()
    parcel = max(1, total // PARCELS)
    lanes = max(1, min(PARCELS, -(-n // LANE_GROUPS)))

    def pack_lane(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["size", "__digest"], ascending=[False, True], ignore_index=True)
        bins = best_fit(pdf["size"].tolist(), parcel)
        return pdf.assign(parcel=bins)[["__digest", "size", "lane", "parcel"]]

    parcels = stash(
        groups.withColumn("lane", F.pmod(F.xxhash64("__digest"), F.lit(lanes)))
        .groupBy("lane")
        .applyInPandas(pack_lane, "__digest binary, size bigint, lane bigint, parcel bigint"),
        "shard-parcels",
    )
    sizes = parcels.groupBy("lane", "parcel").agg(F.sum("size").alias("size"))
    listed = sizes.orderBy("lane", "parcel").collect()  # at most 3 * PARCELS rows
    placed = even_bins([r["size"] for r in listed], shards)
    where = spark.createDataFrame(
        [(r["lane"], r["parcel"], s) for r, s in zip(listed, placed)],
        "lane bigint, parcel bigint, shard int",
    )
    found = parcels.join(F.broadcast(where), ["lane", "parcel"]).select("__digest", "shard")
    joined = rows.join(found, "__digest").drop("__digest")
    joined = stash(joined.withColumn("__id", F.monotonically_increasing_id()), "sharded")
    return dense_order(joined, ["shard"], ["__id"], "slot").drop("__id")
