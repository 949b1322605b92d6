"""Ingest counters per topic and their roll-up, and the numbers kept per flush."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from wattfold import schemas
from wattfold.sources.readings import LOAD, decoded_with_fault

INTERVAL_SECONDS = 10


def ingest_rate(readings: DataFrame, interval: int = INTERVAL_SECONDS) -> DataFrame:
    """Messages and load messages per topic and interval, with both rates per second.

    ``readings`` carry a ``topic``. On a stream with a watermark on ``ts`` this is a
    tumbling window; the batch form floors the same seconds.
    """
    at = (
        F.window("ts", f"{interval} seconds").getField("start")
        if readings.isStreaming
        else F.timestamp_seconds(F.col("timestamp") - F.pmod(F.col("timestamp"), F.lit(interval)))
    )
    counted = readings.groupBy("topic", at.alias("interval_start")).agg(
        F.count(F.lit(1)).alias("total"), F.count_if(F.col("property") == LOAD).alias("load")
    )
    return counted.withColumns(
        {"total_speed": F.col("total") / interval, "load_speed": F.col("load") / interval}
    )


def ingest_counts(messages: DataFrame, text: str = "value") -> DataFrame:
    """Per topic of CSV messages: how many came, how many could be used and how many not.

    One grouped pass; the counts of several deliveries add up.
    """
    tested = decoded_with_fault(messages, text)
    return tested.groupBy("topic").agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("reason").isNull()).alias("success"),
        F.count_if(F.col("reason").isNotNull()).alias("fail"),
    )


def ingest_snapshots(
    readings: DataFrame,
    counts: DataFrame,
    now: Column,
    queued: DataFrame | None = None,
    idle_seconds: int = 3600,
) -> DataFrame:
    """The newest state of each feed as a JSON message.

    ``readings`` are the usable ones with their ``topic``, ``counts`` come from
    ``ingest_counts``, and ``queued`` may give per ``topic`` the messages of the feed not yet
    taken (``queue``). A feed counts as connected if a usable reading of it lies within
    ``idle_seconds`` of ``now``; speeds are those of its last interval.
    """
    newest = ingest_rate(readings).groupBy("topic").agg(
        F.max_by(F.struct("total_speed", "load_speed"), "interval_start").alias("speed"),
        F.max("interval_start").alias("last"),
        F.sum("load").alias("load"),
    )
    known = counts.join(newest, "topic", "left")
    if queued is not None:
        known = known.join(queued.select("topic", "queue"), "topic", "full")
    queue = F.col("queue") if queued is not None else F.lit(None).cast("bigint")
    none = F.lit(0).cast("bigint")
    state = F.struct(
        F.col("topic").alias("name"),
        F.coalesce(F.unix_seconds("last") >= F.unix_seconds(now) - idle_seconds, F.lit(False)).alias("connect"),
        F.coalesce("speed.total_speed", F.lit(0.0)).alias("totalSpeed"),
        F.coalesce("speed.load_speed", F.lit(0.0)).alias("loadSpeed"),
        F.coalesce("total", none).alias("total"),
        F.coalesce("load", none).alias("load"),
        F.coalesce(queue, none).alias("queue"),
        F.coalesce("success", none).alias("success"),
        F.coalesce("fail", none).alias("fail"),
    )
    return known.select("topic", F.to_json(state).alias("value"))


def ingest_rollup(snapshots: DataFrame, text: str = "value") -> DataFrame:
    """JSON snapshots of all feeds as one row: sums, and connected only if all are."""
    parsed = snapshots.select(F.from_json(text, schemas.INGEST_SNAPSHOT).alias("s")).select("s.*")
    return parsed.agg(
        F.bool_and("connect").alias("connect"),
        F.sum("totalSpeed").alias("total_speed"),
        F.sum("loadSpeed").alias("load_speed"),
        *[F.sum(c).alias(c) for c in ("total", "load", "queue", "success", "fail")],
    )


def batch_metrics(saved: dict[str, DataFrame], raised: dict[str, DataFrame]) -> DataFrame:
    """Slices saved and alerts raised per level and gap."""

    def counts(frames, slices, alerts):
        return [
            df.select(F.lit(level).alias("level"), "slice_gap", slices.alias("s"), alerts.alias("a"))
            for level, df in frames.items()
        ]

    rows = counts(saved, F.lit(1), F.lit(0)) + counts(raised, F.lit(0), F.lit(1))
    return (
        reduce(lambda a, b: a.unionByName(b), rows)
        .groupBy("level", "slice_gap")
        .agg(F.sum("s").alias("slices_saved"), F.sum("a").alias("alerts_raised"))
    )
