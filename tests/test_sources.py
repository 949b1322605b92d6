from pyspark.sql import functions as F

from wattfold import schemas
from wattfold.operators.ingest import ingest_counts, ingest_rate, ingest_rollup, ingest_snapshots
from wattfold.sources.readings import decode_readings, encode_readings, load_only, quarantine, union_topics

LINES = [
    "1,1704067200,68.35,1,0,0,0",
    "2,1704067259,71.65,1,0,0,0",
    "3,1704067259,1203,0,0,0,0",
    "4,notatime,1.0,1,0,0,0",
    "5,1704067260,1.0",
    "no id,1704067261,5,1,7,8,9,extra",
    "6,1704067260,NaN,1,0,0,0",
    "",
]


def lines(spark):
    return spark.createDataFrame([(v,) for v in LINES], "value string")


def test_decode_leaves_bad_messages_out(spark):
    rows = decode_readings(lines(spark)).orderBy("timestamp", "property").collect()
    assert [(r.id, r.timestamp, r.value, r.property, r.plug_id) for r in rows] == [
        (1, 1704067200, 68.35, 1, 0),
        (3, 1704067259, 1203.0, 0, 0),
        (2, 1704067259, 71.65, 1, 0),
        (None, 1704067261, 5.0, 1, 7),
    ]
    assert {r.value for r in quarantine(lines(spark)).collect()} == {LINES[3], LINES[4], LINES[6], LINES[7]}


def test_faults_are_told_apart(spark):
    bad = {
        "1,1704070800000,1,1,0,0,0": "time",  # milliseconds
        "2,99999999999999999,1,1,0,0,0": "time",
        "3,1704067200,1e300,1,0,0,0": "value",
        "4,1704067200,1e-20,1,0,0,0": "value",
        "5,1704067200,inf,1,0,0,0": "value",
        "6,1704067200,1,1,0,0": "missing",
        "7,1704167200,1,1,0,0,0": "early",
    }
    good = ["8,1704067200,0.0000004,1,0,0,0", "9,1704067200,0,1,0,0,0"]
    rows = spark.createDataFrame([(v,) for v in [*bad, *good]], "value string")
    rows = rows.withColumn("at", F.lit("2024-01-01 00:00:00").cast("timestamp"))
    assert {r.value: r.reason for r in quarantine(rows, arrival="at").collect()} == bad
    assert sorted(r.value for r in decode_readings(rows, arrival="at").collect()) == [0, 4e-7]


def test_events_with_faults(spark):
    from datetime import datetime

    from wattfold.sources.readings import events_schema, quarantine_events, readings_from_events

    at = datetime(2024, 1, 1)
    rows = [(1, at, 3, None, 2.0, None), (2, at, None, "view", 2.0, None), (3, None, 3, "view", 2.0, None), (4, at, 3, "view", 1e20, None)]
    events = spark.createDataFrame(rows, events_schema())
    assert [r.id for r in readings_from_events(events).collect()] == [1]
    assert {r.id: r.reason for r in quarantine_events(events).collect()} == {2: "missing", 3: "missing", 4: "value"}


def test_decode_keeps_other_columns(spark):
    df = decode_readings(lines(spark).withColumn("topic", F.lit("a")))
    assert {r.topic for r in df.collect()} == {"a"} and "value" in df.columns


def test_encode_then_decode_is_the_same(small_readings):
    again = decode_readings(encode_readings(small_readings))
    assert again.exceptAll(small_readings).isEmpty() and small_readings.exceptAll(again).isEmpty()


def test_load_only(spark):
    assert decode_readings(lines(spark)).count() == 4
    assert load_only(decode_readings(lines(spark))).count() == 3


def test_rates_are_not_cut_to_whole_numbers(readings):
    rows = readings(
        ("2024-01-01T00:00:00", 1),
        ("2024-01-01T00:00:09", 1, 0, 0, 0, 0),
        ("2024-01-01T00:00:09", 1),
        ("2024-01-01T00:00:10", 1),
    )
    got = ingest_rate(union_topics({"t": rows})).orderBy("interval_start").collect()
    assert [(r.total, r.load, r.total_speed, r.load_speed) for r in got] == [(3, 2, 0.3, 0.2), (1, 1, 0.1, 0.1)]


def test_rollup_is_connected_only_if_all_feeds_are(readings):
    old = readings(("2024-01-01T00:00:00", 1))
    new = readings(("2024-01-01T06:00:00", 1), ("2024-01-01T06:00:01", 1))
    now = F.lit("2024-01-01 06:00:05").cast("timestamp")
    both = union_topics({"old": old, "new": new})
    counts = ingest_counts(encode_feeds(both).withColumn("value", F.expr("if(topic = 'old', concat(value, 'x'), value)")))
    assert {tuple(r) for r in counts.collect()} == {("old", 1, 0, 1), ("new", 2, 2, 0)}
    queued = counts.select(F.lit("idle").alias("topic"), F.lit(7).alias("queue")).limit(1)
    row = ingest_rollup(ingest_snapshots(both, counts, now, queued)).first()
    assert (row.connect, row.total, row.load, row.total_speed) == (False, 3, 3, 0.1 + 0.2)
    assert (row.queue, row.success, row.fail) == (7, 2, 1)
    only = union_topics({"new": new})
    assert ingest_rollup(ingest_snapshots(only, ingest_counts(encode_feeds(only)), now)).first().connect


def encode_feeds(rows):
    return rows.select("topic", F.concat_ws(",", *schemas.READING.names).alias("value"))
