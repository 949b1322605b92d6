"""Readings: decoding CSV messages, adapting stored events, and opening feeds."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from wattfold import schemas
from wattfold.functions import numeric
from wattfold.session import utc

LOAD = 1

# The seconds of the years 1000 to 9999, and how far a reading may run ahead of its arrival.
FIRST_SECOND, LAST_SECOND = -30_610_224_000, 253_402_300_799
AHEAD_SECONDS = 24 * 3600

# Position of each field in a CSV message; position 0 is the message id and may be anything.
_POSITIONS = {name: i for i, name in enumerate(schemas.READING.names)}
_REQUIRED = [n for n in schemas.READING.names if n != "id"]


def _decoded(lines: DataFrame, text: str) -> DataFrame:
    # Exploding the one split keeps the optimizer from splitting again for every field.
    parts = F.col("_parts")
    split = lines.withColumn("_parts", F.explode(F.array(F.split(F.col(text), ","))))
    return split.withColumns(
        {
            f.name: F.get(parts, F.lit(_POSITIONS[f.name])).try_cast(f.dataType)
            for f in schemas.READING
        }
    ).drop("_parts")


def _arrival(rows: DataFrame, arrival):
    """When rows arrived: the named column, on a stream the time of the batch, else unknown.

    ``False`` switches the test for readings ahead of their time off.
    """
    if arrival is None and rows.isStreaming:
        return F.current_timestamp()
    return F.col(arrival) if arrival else None


def fault(arrival=None):
    """Why a reading cannot be used, null if it can.

    ``missing``: a field is absent or does not parse. ``value``: no finite number that
    sums can hold. ``time``: no year of four digits, as when milliseconds come for seconds.
    ``early``: stamped more than ``AHEAD_SECONDS`` after the time ``arrival``.
    """
    present = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in _REQUIRED])
    found = (
        F.when(~present, "missing")
        .when(~numeric.holdable(F.col("value")) | F.isnan("value"), "value")
        .when(~F.col("timestamp").between(FIRST_SECOND, LAST_SECOND), "time")
    )
    if arrival is not None:
        found = found.when(F.col("timestamp") > F.unix_seconds(arrival) + AHEAD_SECONDS, "early")
    return found


def decode_readings(lines: DataFrame, text: str = "value", arrival: str | bool | None = None) -> DataFrame:
    """CSV messages to typed readings; messages with a ``fault`` are left out.

    ``text`` names the message column; other columns (topic, arrival time) are kept.
    ``arrival`` may name a timestamp column to hold far-future readings against; a stream
    holds them against the time of the batch unless it is ``False``.
    """
    source = lines.withColumnRenamed(text, "_message")
    found = fault(_arrival(lines, arrival))
    return _decoded(source, "_message").where(found.isNull()).drop("_message")


def quarantine(lines: DataFrame, text: str = "value", arrival: str | bool | None = None) -> DataFrame:
    """The messages ``decode_readings`` leaves out, untouched, with the ``reason``."""
    source = lines.withColumnRenamed(text, "_message")
    rest = [c for c in source.columns if c != "_message"]
    bad = _decoded(source, "_message").withColumn("reason", fault(_arrival(lines, arrival)))
    return bad.where(F.col("reason").isNotNull()).select(*rest, F.col("_message").alias(text), "reason")


def decoded_with_fault(lines: DataFrame, text: str = "value", arrival: str | bool | None = None) -> DataFrame:
    """Every message decoded as far as it goes, with the ``reason`` it cannot be used, null if it can."""
    source = lines.withColumnRenamed(text, "_message")
    return _decoded(source, "_message").withColumn("reason", fault(_arrival(lines, arrival))).drop("_message")


def encode_readings(readings: DataFrame, text: str = "value") -> DataFrame:
    """Readings back to CSV messages."""
    return readings.select(
        F.concat_ws(",", *[F.col(c).cast("string") for c in schemas.READING.names]).alias(text)
    )


def load_only(readings: DataFrame) -> DataFrame:
    return readings.where(F.col("property") == LOAD)


def union_topics(feeds: Mapping[str, DataFrame]) -> DataFrame:
    """One flow out of several feeds, each row marked with the topic it came from."""
    marked = [df.withColumn("topic", F.lit(topic)) for topic, df in feeds.items()]
    return reduce(lambda a, b: a.unionByName(b), marked)


def readings_from_events(events: DataFrame, arrival: str | bool | None = None) -> DataFrame:
    """Adapter from the generic ``events`` table.

    ``event_type`` stands in for the measured property, and ``user_id`` is spread over
    five houses of three households, so that every user is one device. Events with a
    ``fault`` are left out; ``quarantine_events`` has them. ``arrival`` as for ``decode_readings``.
    """
    return _adapted(events).where(fault(_arrival(events, arrival)).isNull()).select(*schemas.READING.names)


def quarantine_events(events: DataFrame, arrival: str | bool | None = None) -> DataFrame:
    """The events ``readings_from_events`` leaves out, as readings with the ``reason``."""
    bad = _adapted(events).withColumn("reason", fault(_arrival(events, arrival)))
    return bad.where(F.col("reason").isNotNull()).select(*schemas.READING.names, "reason")


def _adapted(events: DataFrame) -> DataFrame:
    user = F.col("user_id")
    return events.select(
        "*",
        F.col("event_id").cast("bigint").alias("id"),
        F.unix_seconds(F.col("ts").cast("timestamp")).alias("timestamp"),
        F.when(F.col("event_type").eqNullSafe("error"), 0).otherwise(LOAD).alias("property"),
        F.floor(user / 15).cast("int").alias("plug_id"),
        F.pmod(F.floor(user / 5), F.lit(3)).cast("int").alias("household_id"),
        F.pmod(user, F.lit(5)).cast("int").alias("house_id"),
    )


def events_schema() -> T.StructType:
    return T.StructType(
        [
            T.StructField("event_id", T.LongType()),
            T.StructField("ts", T.TimestampNTZType()),
            T.StructField("user_id", T.LongType()),
            T.StructField("event_type", T.StringType()),
            T.StructField("value", T.DoubleType()),
            T.StructField("props", T.StringType()),
        ]
    )


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return utc(spark).read.schema(events_schema()).parquet(f"{sf_dir}/events.parquet")


def stream_events(spark: SparkSession, path: str, **options) -> DataFrame:
    return utc(spark).readStream.schema(events_schema()).options(**options).parquet(path)


def stream_messages(spark: SparkSession, path: str, **options) -> DataFrame:
    """CSV messages arriving as text files, one message a line."""
    return utc(spark).readStream.options(**options).text(path)


def stream_topics(spark: SparkSession, servers: str, topics, **options) -> DataFrame:
    """CSV messages from Kafka topics; needs the Kafka connector on the class path."""
    feed = (
        utc(spark)
        .readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", ",".join(topics))
        .options(**options)
        .load()
    )
    return feed.select(F.col("topic"), F.col("value").cast("string").alias("value"))


def drop_repeats(readings: DataFrame, watermark_minutes: int) -> DataFrame:
    """Streaming option, off by default: keep one copy per message id inside the watermark."""
    timed = readings.withColumn("ts", F.timestamp_seconds("timestamp"))
    return timed.withWatermark("ts", f"{watermark_minutes} minutes").dropDuplicatesWithinWatermark(["id"])
