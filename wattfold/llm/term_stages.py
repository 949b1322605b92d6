"""Ranked lexical search over a term-partitioned index, owner by owner (operator 11)."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattfold.llm.common import stash
from wattfold.llm.words import TERMS, pieces
from wattfold.session import scratch_dir

OWNERS = 4  # stages: term owners that a bundle visits, rarest terms first
BUNDLE = 256  # items that travel together, about
BLOCK = 2048  # documents whose accumulators travel together, about

_PACKED = "bundle int, block int, slots binary, ats binary, scores binary, best array<struct<slot int, at int, score bigint>>"


def tallies(rows: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``id, n, terms, tfs``: a text's number of terms, its distinct terms and their counts.

    Terms are maximal runs of ASCII letters and digits and of characters beyond ASCII, in
    UTF-8, with A-Z in lower case. A null text has none.
    """
    given = rows.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("binary").alias("text"))
    more = T._parse_datatype_string("n bigint, terms array<binary>, tfs array<int>")
    schema = T.StructType([given.schema["id"], *more.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            totals, ends, terms, tfs = [], [0], [], []
            for text in batch.column("text"):
                found = Counter()
                for words in pieces(text.as_py() or b"", TERMS):
                    found.update(words)
                terms += found.keys()
                tfs += found.values()
                ends.append(len(terms))
                totals.append(sum(found.values()))
            columns = [
                batch.column("id"),
                pa.array(totals, pa.int64()),
                pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(terms, pa.binary())),
                pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(tfs, pa.int32())),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return given.mapInArrow(run, schema)


def _exploded(rows: DataFrame, *keep: str) -> DataFrame:
    pairs = rows.select(*keep, F.explode(F.arrays_zip("terms", "tfs")).alias("x"))
    return pairs.select(*keep, F.col("x.terms").alias("term"), F.col("x.tfs").alias("tf"))


def _impacts(tall: DataFrame, wanted: DataFrame, documents: int, terms: int) -> DataFrame:
    """``block, at, id, term, impact`` of every document and wanted term it holds.

    A document's place ``at`` in its block follows its id, so that equal scores settle by place.
    """
    blocks = max(1, -(-documents // BLOCK))
    m = 25 + F.expr(f"(75 * n * {documents}L) div {terms}L")
    held = _exploded(tall, "row", "id", "n").join(wanted.select("term").distinct(), "term")
    held = held.select(
        F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int").alias("block"),
        "row",
        "id",
        "term",
        F.col("tf").cast("bigint").alias("tf"),
        m.alias("m"),
    )
    place = Window.partitionBy("block").orderBy(F.col("id").asc_nulls_last(), "row")
    placed = held.withColumn("at", (F.dense_rank().over(place) - 1).cast("int"))
    return placed.select("block", "at", "id", "term", F.expr("(1000000000L * tf) div (1000L * tf + 8L * m)").alias("impact"))


def _owned(postings: DataFrame, documents: int) -> DataFrame:
    """``term, t, w, top, owner`` of the vocabulary; owners hold about equally many postings.

    ``top`` bounds what one occurrence of the term in an item can add to any document.
    """
    weight = F.floor(1000 * F.log(F.lit(2.0 * documents + 2) / (2 * F.col("df") + 1)))
    counted = postings.groupBy("term").agg(F.count("*").alias("df"), F.max("impact").alias("most"))
    vocabulary = stash(counted.withColumn("w", weight).withColumn("t", F.monotonically_increasing_id()), "vocabulary")
    shares = [i / OWNERS for i in range(1, OWNERS)]
    cuts = vocabulary.agg(F.percentile("w", F.array(*map(F.lit, shares)), F.col("df"))).first()[0]
    owner = sum((F.when(F.col("w") < cut, 1).otherwise(0) for cut in cuts), F.lit(0))
    return vocabulary.select("term", "t", "w", (F.col("w") * F.col("most")).alias("top"), owner.alias("owner"))


def _visit(k: int):
    """One owner's work on one bundle and block: add its postings, then drop what cannot win.

    A document stays for an item while its sum, and all that later owners could add to it,
    reaches the item's floor, a score that at least ``k`` documents have by now. One that
    was dropped and comes up again has a sum that is too low, but never reaches the floor.
    """

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left):
            return pd.DataFrame(columns=["bundle", "block", "slots", "ats", "scores", "best"])
        row = left.iloc[0]
        rest, floor = np.asarray(row["rest"], np.int64), np.asarray(row["floor"], np.int64)
        slots, ats = np.frombuffer(row["slots"], np.int32), np.frombuffer(row["ats"], np.int32)
        order = np.argsort(right["t"].to_numpy(), kind="stable")
        t, at, add = (right[c].to_numpy()[order] for c in ("t", "at", "add"))
        sums = np.zeros((len(rest), max(at.max(initial=-1), ats.max(initial=-1)) + 1), np.int64)
        sums[slots, ats] = np.frombuffer(row["scores"], np.int64)
        asked = [(a["slot"], a["t"], a["qtf"]) for a in row["ask"]]
        firsts = np.searchsorted(t, [a[1] for a in asked], "left")
        lasts = np.searchsorted(t, [a[1] for a in asked], "right")
        for (slot, _, qtf), a, b in zip(asked, firsts, lasts):
            sums[slot, at[a:b]] += qtf * add[a:b]
        sums[sums + rest[:, None] < floor[:, None]] = 0
        slots, ats = (x.astype(np.int32) for x in np.nonzero(sums))
        best = []
        if sums.shape[1]:
            # Stable, so equal scores stay in the order of places.
            leading = np.argsort(-sums, axis=1, kind="stable")[:, :k]
            for slot, places in enumerate(leading):
                best += [(slot, int(p), int(sums[slot, p])) for p in places if sums[slot, p] > 0]
        return pd.DataFrame(
            {
                "bundle": [row["bundle"]],
                "block": [row["block"]],
                "slots": [slots.tobytes()],
                "ats": [ats.tobytes()],
                "scores": [sums[slots, ats].tobytes()],
                "best": [[{"slot": s, "at": p, "score": x} for s, p, x in best]],
            }
        )

    return run


def top_documents(
    docs: DataFrame,
    items: DataFrame,
    k: int = 10,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """``item_id, rank, doc_id, score``: each item's ``k`` best documents with a score above 0.

    The vocabulary of the items is dealt to term owners by weight. Items travel in bundles
    through the owners' stages, one after the other, and a bundle carries for each block of
    documents a sparse table of integer sums, which a stage cogroups with the postings of
    its owner's terms. After a stage the k-th best sum of each item so far becomes its floor.
    A task holds one bundle's sums for one block: some ``BUNDLE`` x ``BLOCK`` longs at most.

    Null and empty texts have no terms; such documents are never found and not counted, such
    items find nothing. Equal scores go by ascending document id, nulls last. Repeated
    documents are ranked one by one, repeated items answered one by one, an item with
    a null id under null. Either table may be empty. Other columns are ignored.
    """
    spark = docs.sparkSession
    tall = stash(tallies(docs, id_col, text_col).withColumn("row", F.monotonically_increasing_id()), "tallies")
    asked = stash(tallies(items, item_col, item_text).withColumn("item", F.monotonically_increasing_id()), "items")
    documents, terms = tall.where("n > 0").agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    out = f"item_id {asked.schema['id'].dataType.simpleString()}, rank int, doc_id {tall.schema['id'].dataType.simpleString()}, score bigint"
    wanted = _exploded(asked, "item").withColumnRenamed("tf", "qtf")
    if not documents or wanted.isEmpty():
        return spark.createDataFrame([], out)
    postings = stash(_impacts(tall, wanted, documents, terms), "postings")
    vocabulary = _owned(postings, documents) if not postings.isEmpty() else None
    if vocabulary is None:
        return spark.createDataFrame([], out)

    bundles = max(1, -(-asked.count() // BUNDLE))
    blocks = max(1, -(-documents // BLOCK))
    seats = asked.select("item", "id", F.pmod(F.xxhash64("item"), F.lit(bundles)).cast("int").alias("bundle"))
    seats = seats.withColumn("slot", F.row_number().over(Window.partitionBy("bundle").orderBy("item")) - 1)
    seats = stash(seats, "seats")
    asks = stash(
        wanted.join(vocabulary, "term").join(seats, "item").select("bundle", "slot", "owner", "t", "qtf", "top"), "asks"
    )
    index = f"{scratch_dir(spark, 'index')}/data"
    # A posting is sent to each bundle that asks for its term.
    routed = postings.join(vocabulary, "term").join(asks.select("bundle", "t").distinct(), "t")
    routed.select("owner", "bundle", "block", "t", "at", (F.col("w") * F.col("impact")).alias("add")).write.partitionBy(
        "owner"
    ).parquet(index)
    index = spark.read.schema("bundle int, block int, t bigint, at int, add bigint, owner int").parquet(index)

    nothing = F.lit(b"")
    carried = (
        seats.select("bundle").distinct()
        .withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
        .select("bundle", "block", *[nothing.alias(c) for c in ("slots", "ats", "scores")])
    )
    floors = seats.select("bundle", "slot", F.lit(1).cast("bigint").alias("floor"))
    for owner in range(OWNERS):
        left = carried.join(_orders(asks, seats, floors, owner), "bundle")
        right = index.where(F.col("owner") == owner).drop("owner")
        moved = left.groupBy("bundle", "block").cogroup(right.groupBy("bundle", "block")).applyInPandas(_visit(k), _PACKED)
        moved = stash(moved, f"stage-{owner}")
        carried = moved.drop("best")
        best = moved.select("bundle", "block", F.inline("best"))
        ranked = best.withColumn(
            "nth", F.row_number().over(Window.partitionBy("bundle", "slot").orderBy(F.desc("score")))
        ).where(F.col("nth") == k)
        floors = ranked.select("bundle", "slot", F.col("score").alias("floor"))
    places = postings.select("block", "at", F.col("id").alias("doc_id")).distinct()
    order = Window.partitionBy("bundle", "slot").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    ranked = best.join(places, ["block", "at"]).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    named = seats.select("bundle", "slot", F.col("id").alias("item_id"))
    return ranked.join(named, ["bundle", "slot"]).select("item_id", "rank", "doc_id", "score")


def _orders(asks: DataFrame, seats: DataFrame, floors: DataFrame, owner: int) -> DataFrame:
    """What a bundle takes to an owner: its terms there, and per slot the bound on what is left and the floor."""
    ask = F.collect_list(F.when(F.col("owner") == owner, F.struct("slot", "t", "qtf")))
    later = F.sum(F.when(F.col("owner") > owner, F.col("qtf") * F.col("top")).otherwise(0))
    left = asks.groupBy("bundle", "slot").agg(later.cast("bigint").alias("rest"))
    per_slot = seats.select("bundle", "slot").join(left, ["bundle", "slot"], "left").join(floors, ["bundle", "slot"], "left")
    lists = per_slot.groupBy("bundle").agg(
        F.sort_array(
            F.collect_list(F.struct("slot", F.coalesce("rest", F.lit(0)).alias("rest"), F.coalesce("floor", F.lit(1)).alias("floor")))
        ).alias("all")
    )
    lists = lists.select("bundle", F.col("all.rest").alias("rest"), F.col("all.floor").alias("floor"))
    terms = asks.groupBy("bundle").agg(ask.alias("ask"))
    return lists.join(terms, "bundle", "left").withColumn("ask", F.coalesce("ask", F.expr("array()")))


SQL = """
WITH terms AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS t
  FROM documents
), docs AS (
  SELECT doc_id, len(t)::BIGINT AS n, t FROM terms WHERE len(t) > 0
), tf AS (
  SELECT doc_id, n, term, count(*)::BIGINT AS tf FROM (SELECT doc_id, n, unnest(t) AS term FROM docs) GROUP BY ALL
), asked AS (
  SELECT item_id, term, count(*)::BIGINT AS qtf FROM (
    SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM benchmark)
  GROUP BY ALL
), totals AS (SELECT count(*)::BIGINT AS nd, sum(n)::BIGINT AS nl FROM docs
), weights AS (
  SELECT term, floor(1000 * ln((2.0 * nd + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM tf, totals GROUP BY term, nd
), scored AS (
  SELECT item_id, doc_id,
         sum(qtf * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * nd) // nl))))::BIGINT AS score
  FROM asked JOIN tf USING (term) JOIN weights USING (term), totals GROUP BY item_id, doc_id
), ranked AS (
  SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
  FROM scored WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""
