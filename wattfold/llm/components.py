"""Connected components of a link table, by star contraction in DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattfold.llm.common import stash

FEW = 100000  # so many links are worked on in one partition, without an exchange


def _ways(links: DataFrame, *ends: tuple[str, str]) -> DataFrame:
    """``u, v`` for each of the given pairs of columns, from one read and in the same partitions."""
    rows = F.array(*[F.struct(F.col(u).alias("u"), F.col(v).alias("v")) for u, v in ends])
    return links.select(F.explode(rows).alias("x")).select("x.u", "x.v")


def _least(links: DataFrame) -> DataFrame:
    """Each ``u`` with the least of itself and its neighbours; combined map-side, so hubs are cheap."""
    return links.groupBy(F.col("u").alias("__u")).agg(F.min("v").alias("__v")).select(
        "__u", F.least("__u", "__v").alias("m")
    )


def components(links: DataFrame, a: str = "a", b: str = "b", label: str = "links") -> DataFrame:
    """``node, root`` for every node with a link; the root is the component's least node.

    Distributed union-find: in turns, every node's larger neighbours, then its smaller ones,
    are linked to the least node it knows, until nothing changes; each round at least
    halves the paths. Links stay a table in the shared folder between rounds and nothing
    but their number and checksum reaches the driver. Self links and repeats do no harm.
    Up to ``FEW`` links are one partition, as a round of them costs little but its exchanges.
    """
    edges = links.where(F.col(a) != F.col(b)).select(
        F.greatest(a, b).alias("u"), F.least(a, b).alias("v")
    )
    edges, before = stash(edges.distinct(), label), None
    while True:
        now = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if now == before or not now[0]:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
                edges.select("v", "v").distinct()
            )
        before = now
        few = now[0] <= FEW
        edges = edges.coalesce(1) if few else edges
        least = lambda links: _least(links).hint("merge") if few else _least(links)
        both = _ways(edges, ("u", "v"), ("v", "u"))
        large = (
            both.join(least(both), F.col("u") == F.col("__u"))
            .where(F.col("v") > F.col("u"))
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .distinct()
        )
        small = large.join(least(large), F.col("u") == F.col("__u"))
        edges = stash(_ways(small, ("v", "m"), ("u", "m")).where(F.col("u") != F.col("v")).distinct(), label)


def merged(roots: DataFrame, links: DataFrame) -> DataFrame:
    """``roots`` after more links ``a, b``: only the components these touch are worked on."""
    side = lambda c: roots.select(F.col("node").alias(c), F.col("root").alias(f"root_{c}"))
    lifted = links.join(side("a"), "a", "left").join(side("b"), "b", "left").select(
        F.coalesce("root_a", "a").alias("a"), F.coalesce("root_b", "b").alias("b")
    )
    over = stash(components(lifted), "merged-roots")
    known = roots.union(over.join(roots, "node", "left_anti").select("node", F.col("node").alias("root")))
    up = over.select(F.col("node").alias("__node"), F.col("root").alias("__root"))
    return stash(
        known.join(up, F.col("root") == F.col("__node"), "left").select("node", F.coalesce("__root", "root").alias("root")),
        "roots",
    )
