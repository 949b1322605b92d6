import json

import pytest
from pyspark.sql import functions as F

from wattfold.config import AlertConfig
from wattfold.operators import alerts as A
from wattfold.operators.baseline import attach_baseline, baselines, merge_baselines, running_baseline

DAYS = [
    ("2024-01-01 00:00:00", 10),
    ("2024-01-01 01:00:00", 0),
    ("2024-01-01 02:00:00", 4),
    ("2024-01-02 00:00:00", 13),
    ("2024-01-04 00:00:00", 1),
]


def prior(df):
    rows = df.orderBy("slice_start").select("prior_min", "prior_avg", "prior_max", "prior_count").collect()
    return [tuple(r) for r in rows]


def test_running_baseline_sees_only_earlier_slices_and_skips_zeros(slices):
    assert prior(running_baseline(slices("house", 60, *DAYS), "house")) == [
        (0, 0, 0, 0),
        (10, 10, 10, 1),
        (10, 10, 10, 1),
        (4, 7, 10, 2),
        (4, 9, 13, 3),
    ]


def test_zero_seed_keeps_the_minimum_at_zero(slices):
    got = prior(running_baseline(slices("house", 60, *DAYS), "house", seed_zero=True))
    assert [r[0] for r in got] == [0, 0, 0, 0, 0]


def test_gaps_and_entities_do_not_mix(slices):
    both = slices("house", 60, *DAYS).unionByName(slices("house", 120, ("2024-01-05 00:00:00", 50)))
    both = both.unionByName(slices("house", 60, ("2024-01-05 00:00:00", 50, 1)))
    late = running_baseline(both, "house").where("slice_date = '2024-01-05'")
    assert [r.prior_count for r in late.collect()] == [0, 0]


def test_final_and_merged_baselines(slices):
    all_days = slices("house", 60, *DAYS)
    whole = baselines(all_days, "house").first()
    assert (whole.min, whole.avg, whole.max, whole["count"]) == (1, 7, 13, 4)
    old, new = (all_days.where(F.dayofmonth("slice_date").between(*span)) for span in ((1, 1), (2, 4)))
    merged = merge_baselines(baselines(old, "house"), baselines(new, "house"), "house").first()
    assert merged == whole


def test_carried_baselines_continue_the_running_ones(slices):
    all_days = slices("house", 60, *DAYS)
    carried = baselines(all_days.where("slice_date = '2024-01-01'"), "house")
    rest = running_baseline(all_days.where("slice_date > '2024-01-01'"), "house", start=carried)
    assert prior(rest) == [(4, 7, 10, 2), (4, 9, 13, 3)]


def test_attach_baseline_defaults_to_zero(slices):
    df = slices("house", 60, ("2024-01-09 00:00:00", 1), ("2024-01-09 00:00:00", 1, 7))
    stored = baselines(slices("house", 60, *DAYS), "house")
    got = attach_baseline(df, stored, "house").orderBy("house_id").collect()
    assert [(r.prior_min, r.prior_max, r.prior_count) for r in got] == [(1, 13, 4), (0, 0, 0)]


def test_rules_at_their_edge(slices):
    rows = [("2024-01-01 00:00:00", 10), ("2024-01-01 01:00:00", 12), ("2024-01-01 02:00:00", 14.3), ("2024-01-01 03:00:00", 8)]
    checks = AlertConfig(pct=20, check_min=True, check_avg=True, check_max=True)
    got = A.alerts(slices("house", 60, *rows), "house", checks).collect()
    # 12 is exactly 20 % over 10; 14.3 is under 1.2 * 12 but over the average 11; 8 is 20 % under.
    assert {(r.slice_index, r.type) for r in got} == {(1, 1), (1, 0), (2, 0), (3, -1)}


def test_under_min_does_not_fire_for_normal_values(slices):
    only_min = AlertConfig(check_min=True, check_avg=False, check_max=False)
    rows = [("2024-01-01 00:00:00", 10), ("2024-01-01 01:00:00", 9.5), ("2024-01-01 02:00:00", 50)]
    assert A.alerts(slices("house", 60, *rows), "house", only_min).isEmpty()


def test_no_history_no_alert(slices):
    rows = [("2024-01-01 00:00:00", 0), ("2024-01-01 01:00:00", 50)]
    assert A.alerts(slices("house", 60, *rows), "house", AlertConfig()).isEmpty()


@pytest.fixture
def device_alert(slices):
    rows = [("2024-01-01 00:00:00", 10, 3, 2, 1), ("2024-01-01 23:00:00", 12.345, 3, 2, 1)]
    return A.alerts(slices("device", 60, *rows), "device", AlertConfig(check_avg=False))


def test_device_alert_topics_and_json(device_alert):
    got = A.alert_topics(device_alert, "device", "lab/").collect()
    assert {r.topic for r in got} == {
        "lab/house-3-notification",
        "lab/household-3-2-notification",
        "lab/device-3-2-1-notification",
        "lab/iot-notification",
    }
    (body,) = {r.value for r in got}
    assert json.loads(body) == {
        "type": 1, "houseId": 3, "householdId": 2, "deviceId": 1, "min": 10.0, "max": 10.0, "avg": 10.0,
        "value": 12.345, "year": "2024", "month": "01", "day": "01", "sliceIndex": 23, "sliceGap": 60,
    }


def test_alert_text(device_alert):
    now = F.lit("2024-01-02 00:05:00").cast("timestamp")
    row = A.alert_messages(device_alert, "device", now).first()
    assert row.title == "Device over utilized"
    assert row.body.split("\n") == [
        "Device 1 of household 2 of house 3 over utilized",
        "Max: 10.00 (W)",
        "Value: 12.35 (W) (+2.35W (23.45%))",
        "Time: 2024/01/01 23:00->24:00 (5 minute(s) ago)",
    ]


def test_titles_name_their_level(slices):
    rows = [("2024-01-01 00:00:00", 10), ("2024-01-01 01:00:00", 5)]
    under = AlertConfig(check_min=True)
    now = F.lit("2024-01-03 00:00:00").cast("timestamp")
    for level in ("household", "house"):
        row = A.alert_messages(A.alerts(slices(level, 60, *rows), level, under), level, now).first()
        assert row.title == f"{level.capitalize()} under utilized"
        assert "Value: 5.00 (W) (-5.00W (-50.00%))" in row.body


@pytest.mark.parametrize(
    "seconds, want",
    [(1, "Just now"), (59, "59 second(s) ago"), (60, "1 minute(s) ago"), (7199, "1 hour(s) ago"), (200000, "2 day(s) ago")],
)
def test_time_ago(spark, seconds, want):
    then, now = F.timestamp_seconds(F.lit(0)), F.timestamp_seconds(F.lit(seconds))
    assert spark.range(1).select(A.time_ago(then, now)).first()[0] == want
