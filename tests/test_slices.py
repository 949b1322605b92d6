import pytest
from pyspark.sql import functions as F

from wattfold.config import EngineConfig, base_gap, block_gap, check_gaps
from wattfold.functions import slices as S
from wattfold.operators.aggregate import assign_slice, multi_window


def parts(df):
    rows = df.select(F.date_format("slice_date", "yyyy-MM-dd"), "slice_index").collect()
    return [tuple(r) for r in rows]


@pytest.mark.parametrize(
    "when, gap, want",
    [
        ("2024-01-01T00:00:00", 60, ("2024-01-01", 0)),
        ("2024-01-01T23:59:59", 60, ("2024-01-01", 23)),
        ("2024-02-29T12:00:00", 120, ("2024-02-29", 6)),
        ("2023-12-31T23:59:59", 1, ("2023-12-31", 1439)),
        ("2024-01-01T00:19:59", 20, ("2024-01-01", 0)),
        ("2024-01-01T00:20:00", 20, ("2024-01-01", 1)),
    ],
)
def test_assign_slice(readings, when, gap, want):
    assert parts(assign_slice(readings((when, 1)), gap)) == [want]


def test_slices_ignore_the_session_zone(spark, readings):
    df = assign_slice(readings(("2024-01-01T00:30:00", 1)), 60)
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        row = df.select(F.unix_date("slice_date"), "slice_index").first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert tuple(row) == (19723, 0)


def test_multi_window_counts_each_reading_once_per_gap(readings):
    df = multi_window(readings(("2024-01-01T01:07:00", 1), ("2024-01-01T02:00:00", 2)), (1, 5, 60))
    got = {(r.slice_gap, r.slice_index) for r in df.collect()}
    assert got == {(1, 67), (5, 13), (60, 1), (1, 120), (5, 24), (60, 2)}


@pytest.mark.parametrize(
    "start, gap, n, want",
    [
        ("2024-01-31 22:00:00", 60, 2, "2024-02-01 00:00:00"),
        ("2024-02-28 23:00:00", 60, 2, "2024-02-29 01:00:00"),
        ("2023-12-31 22:00:00", 120, 2, "2024-01-01 02:00:00"),  # the year rolls over too
        ("2024-03-01 00:00:00", 60, -1, "2024-02-29 23:00:00"),
    ],
)
def test_shift_slice_rolls_the_date(spark, start, gap, n, want):
    df = spark.range(1).select(
        S.shift_slice(F.lit(start).cast("timestamp"), F.lit(gap), n).cast("string").alias("s")
    )
    assert df.first().s == want


def test_labels(slices):
    df = slices("house", 60, ("2024-01-05 23:00:00", 1), ("2024-01-05 00:00:00", 1))
    cols = [F.col(c) for c in ("slice_date", "slice_index", "slice_gap")]
    rows = df.select(S.slice_label(*cols), S.slice_id(*cols), S.date_label(cols[0])).collect()
    assert [tuple(r) for r in rows] == [
        ("2024/01/05 23:00->24:00", "2024-01-05-23-60", "2024/01/05"),
        ("2024/01/05 00:00->01:00", "2024-01-05-0-60", "2024/01/05"),
    ]


def test_parse_slice_id_keeps_the_real_date(spark):
    # Rebuilding slice 0 must not step back a day (2024-01-04, or month 00 on January 1st).
    ids = ["2024-01-05-0-60", "2024-01-01-0-60", "2024-02-29-11-120", "2024-01-05-24-60", "junk", "2024-13-01-0-60"]
    df = spark.createDataFrame([(i,) for i in ids], "t string").withColumns(S.parse_slice_id(F.col("t")))
    rows = df.select(F.col("slice_start").cast("string"), "slice_gap", "slice_index").collect()
    assert [tuple(r) for r in rows] == [
        ("2024-01-05 00:00:00", 60, 0),
        ("2024-01-01 00:00:00", 60, 0),
        ("2024-02-29 22:00:00", 120, 11),
        (None, None, None),
        (None, None, None),
        (None, None, None),
    ]


def test_entity_key(spark):
    assert spark.range(1).select(S.entity_key(F.lit(1), F.lit(2), F.lit(3))).first()[0] == "1-2-3"


def test_gaps_must_divide_the_day():
    assert check_gaps([60, 5, 5]) == (5, 60)
    for bad in ([7], [0], []):
        with pytest.raises(ValueError):
            check_gaps(bad)
    assert (base_gap([10, 15]), block_gap([10, 15])) == (5, 30)
    assert block_gap([1, 5, 10, 15, 20, 30, 60, 120]) == 120


def test_config_from_file_keys():
    conf = EngineConfig.from_mapping(
        {
            "iot analytics.windowList": [60, 1],
            "notification.topicPrefix": "lab/",
            "notification.house.checkAvg": False,
            "notification.device.logGap": 30,
        }
    )
    assert conf.gaps == (1, 60) and conf.topic_prefix == "lab/"
    assert not conf.alerts["house"].check_avg and conf.alerts["house"].check_max
    assert conf.alerts["device"].pct == 30 and conf.alerts["household"].pct == 20
    with pytest.raises(ValueError):
        EngineConfig(watermark_minutes=1200)
