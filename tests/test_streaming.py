import pytest
from pyspark.sql import functions as F

from wattfold.config import LEVELS, AlertConfig, EngineConfig
from wattfold.operators import aggregate
from wattfold.operators.alerts import alerts
from wattfold.operators.baseline import baselines
from wattfold.operators.forecast import forecast_v0
from wattfold.operators.ingest import ingest_rate
from wattfold.sinks.tables import TableStore
from wattfold.sources.readings import decode_readings, encode_readings, stream_messages
from wattfold.streaming.flush import Flush, progress_rows, run_flush

CONFIG = EngineConfig(gaps=(60, 120), alerts={level: AlertConfig(check_min=True) for level in LEVELS})


def same(got, want):
    got = got.select(*want.columns)
    return got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def messages_feed(spark, path):
    return decode_readings(stream_messages(spark, path))


def drop(readings, feed, mode="append"):
    encode_readings(readings).write.mode(mode).text(feed)


def test_stream_leaves_what_batch_computes(spark, small_readings, tmp_path):
    """Three deliveries over a restart each, the later ones reaching back inside the watermark."""
    first_days = small_readings.where(F.col("timestamp") < 1704067200 + 6 * 86400).cache()
    end = F.col("timestamp")
    base = 1704067200 + 4 * 86400
    odd = F.col("id") % 2 == 1
    overlap = end.between(base - 5 * 3600, base)
    parts = [
        first_days.where((end < base) & ~(overlap & odd)),
        first_days.where(overlap & odd),  # late, but within ten hours
        first_days.where(end > base),
    ]
    assert sum(p.count() for p in parts) == first_days.count()
    store = TableStore(spark, str(tmp_path / "tables"))
    feed, checkpoint = str(tmp_path / "feed"), str(tmp_path / "checkpoint")
    sent = []
    for part in parts:
        drop(part, feed)
        query = run_flush(
            messages_feed(spark, feed), store, checkpoint, CONFIG,
            publish=lambda rows: sent.extend(r.topic for r in rows.collect()),
        )
        assert sum(r["dropped_late"] for r in progress_rows(query)) == 0
    device = aggregate.device_slices(first_days, CONFIG.gaps)
    levels = {
        "device": device,
        "household": aggregate.household_slices(device),
        "house": aggregate.house_slices(device),
    }
    for level, want in levels.items():
        assert same(store.read(f"{level}_data"), want), level
        assert same(store.read(f"{level}_notification"), alerts(want, level, CONFIG.alerts[level])), level
        said = forecast_v0(want, level).drop("source_start", "median", "history")
        assert same(store.read(f"{level}_data_forecast"), said), level
        props = store.read(f"{level}_prop")
        through = props.agg(F.max("through")).first()[0]
        closed = want.where(F.col("slice_date") < F.lit(through))
        assert same(props, baselines(closed, level).drop("total")), level
    assert "iot-notification" in sent
    metrics = store.read("flush_metrics").where("level = 'house' AND batch_id = 0")
    assert metrics.where("slices_saved > 0 AND seconds > 0").count() == len(CONFIG.gaps)


def test_first_forecasts_join_no_slice_with_its_past(spark, small_readings, tmp_path, monkeypatch):
    from wattfold.operators import forecast

    def joined(*_):
        raise AssertionError("joined")

    monkeypatch.setattr(forecast, "_median_of_joined", joined)
    part = small_readings.where(F.col("timestamp") < 1704067200 + 4 * 86400)
    store = TableStore(spark, str(tmp_path / "tables"))
    Flush(store, CONFIG, with_alerts=False)(aggregate.base_slices(part, 60), 0)
    for level in LEVELS:
        want = forecast_v0(aggregate.level_slices(part, level, CONFIG.gaps), level).drop("source_start", "median", "history")
        assert same(store.read(f"{level}_data_forecast"), want), level


def test_a_repeated_batch_changes_nothing(spark, small_readings, tmp_path):
    part = small_readings.where(F.col("timestamp") < 1704067200 + 3 * 86400)
    changed = aggregate.base_slices(part, 60)
    store = TableStore(spark, str(tmp_path / "tables"))
    flush = Flush(store, CONFIG)
    flush(changed, 0)
    names = ["house_data", "house_notification", "house_data_forecast", "house_prop"]
    before = {n: {tuple(r) for r in store.read(n).collect()} for n in names}
    flush(changed, 0)
    assert before == {n: {tuple(r) for r in store.read(n).collect()} for n in names}
    assert all(before.values())


def test_a_batch_that_dies_half_way_is_made_good(spark, small_readings, tmp_path, monkeypatch):
    days = [1704067200 + d * 86400 for d in (0, 2, 3)]
    parts = [small_readings.where(F.col("timestamp").between(a, b - 1)) for a, b in zip(days, days[1:])]
    config = EngineConfig(gaps=(120,))
    store = TableStore(spark, str(tmp_path / "tables"))
    Flush(store, config)(aggregate.base_slices(parts[0], 120), 0)

    def die(self, level, *_):
        if level == "household":
            raise RuntimeError("lost")
        return forecast(self, level, *_)

    forecast = Flush._forecast
    with monkeypatch.context() as m:
        m.setattr(Flush, "_forecast", die)
        with pytest.raises(RuntimeError):
            Flush(store, config)(aggregate.base_slices(parts[1], 120), 1)
    Flush(store, config)(aggregate.base_slices(parts[1], 120), 1)
    house = aggregate.level_slices(parts[0].unionByName(parts[1]), "house", (120,))
    household = aggregate.level_slices(parts[0].unionByName(parts[1]), "household", (120,))
    assert same(store.read("house_data"), house)
    assert same(store.read("house_notification"), alerts(house, "house"))
    said = forecast_v0(household, "household").drop("source_start", "median", "history")
    assert same(store.read("household_data_forecast"), said)


def test_ingest_rates_on_a_stream(spark, readings, tmp_path):
    feed = str(tmp_path / "feed")
    drop(readings(("2024-01-01T00:00:00", 1), ("2024-01-01T00:00:09", 1, 0, 0, 0, 0), ("2024-01-01T00:00:10", 1)), feed)
    rows = messages_feed(spark, feed).withColumns({"topic": F.lit("t"), "ts": F.timestamp_seconds("timestamp")})
    rates = ingest_rate(rows.withWatermark("ts", "1 minute"))
    query = (
        rates.writeStream.outputMode("complete").format("memory").queryName("rates").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    got = spark.table("rates").orderBy("interval_start").collect()
    assert [(r.total, r.load, r.total_speed) for r in got] == [(2, 1, 0.2), (1, 1, 0.1)]


def test_readings_behind_the_devices_clock_are_dropped_and_counted(spark, readings, tmp_path):
    feed, checkpoint = str(tmp_path / "feed"), str(tmp_path / "checkpoint")
    store = TableStore(spark, str(tmp_path / "tables"))

    def run():
        return run_flush(messages_feed(spark, feed), store, checkpoint, CONFIG, with_forecasts=False)

    drop(readings(("2024-01-02T00:00:00", 10), ("2024-01-01T12:00:00", 5)), feed)
    run()
    drop(readings(("2024-01-01T12:30:00", 99), ("2024-01-01T20:00:00", 7)), feed)
    query = run()
    assert sum(r["dropped_late"] for r in progress_rows(query)) == 1
    assert store.read("flush_metrics").agg(F.max("readings_late")).first()[0] == 1

    def stored():
        rows = store.read("house_data").where("slice_gap = 60").collect()
        return {(r.slice_date.day, r.slice_index): r.avg for r in rows}

    assert stored() == {(2, 0): 10, (1, 12): 5, (1, 20): 7}

    # Starting over empty, on a new checkpoint, takes the whole feed as one delivery.
    clean = EngineConfig(gaps=(60, 120), clean_tables=True)
    run_flush(
        messages_feed(spark, feed), store, str(tmp_path / "again"), clean, with_alerts=False, with_forecasts=False
    )
    assert stored() == {(2, 0): 10, (1, 12): 52, (1, 20): 7}


def test_bad_readings_do_not_stop_the_stream(spark, tmp_path):
    feed = str(tmp_path / "feed")
    lines = [
        "1,1704070800,5,1,0,0,0",
        "2,1704070800000,7,1,0,0,0",
        "3,1704070800,1e300,1,0,0,0",
        "4,1704070800,1e300,1,0,0,0",
        "5,99999999999999999,7,1,0,0,0",
        "6,1704070860,0.0000004,1,0,0,1",
    ]
    spark.createDataFrame([(x,) for x in lines], "value string").write.text(feed)
    store = TableStore(spark, str(tmp_path / "tables"))
    run_flush(messages_feed(spark, feed), store, str(tmp_path / "checkpoint"), EngineConfig(gaps=(1, 60)))
    got = {(r.house_id, r.slice_gap): r.avg for r in store.read("device_data").collect()}
    assert got == {(0, 1): 5.0, (0, 60): 5.0, (1, 1): 4e-7, (1, 60): 4e-7}


def lagging(readings):
    """House 0 runs on; its second device, a lagging one, comes days later with days long closed."""
    day = [f"2024-01-{d:02d}T{h:02d}:00:00" for d in range(1, 9) for h in (1, 3, 5)]
    prompt = [(t, 10 + i % 5, 0, 0, 0) for i, t in enumerate(day)]
    slow = [(t, 100 + 7 * (i % 3), 0, 0, 1) for i, t in enumerate(day[:12])]
    return [readings(*prompt[:21]), readings(*prompt[21:], *slow[:3]), readings(*slow[3:])]


@pytest.mark.parametrize("guarded", [True, False])
def test_a_wrong_clock_harms_nobody_else(spark, readings, tmp_path, guarded):
    """One reading 40 years ahead, then good ones of all devices, a lagging one among them."""
    feed, checkpoint = str(tmp_path / "feed"), str(tmp_path / "checkpoint")
    store = TableStore(spark, str(tmp_path / "tables"))
    wrong = readings(("2064-01-01T00:00:00", 5, 7, 7, 7))
    parts = lagging(readings)
    late = 0
    for part in [parts[0].unionByName(wrong), *parts[1:]]:
        drop(part, feed)
        rows = decode_readings(stream_messages(spark, feed), arrival=None if guarded else False)
        query = run_flush(rows, store, checkpoint, CONFIG)
        late += sum(r["dropped_late"] for r in progress_rows(query))
    assert late == 0
    good = parts[0].unionByName(parts[1]).unionByName(parts[2])
    device = aggregate.device_slices(good if guarded else good.unionByName(wrong), CONFIG.gaps)
    levels = {"device": device, "household": aggregate.household_slices(device), "house": aggregate.house_slices(device)}
    for level, want in levels.items():
        assert same(store.read(f"{level}_data"), want), level
        assert same(store.read(f"{level}_notification"), alerts(want, level, CONFIG.alerts[level])), level
        said = forecast_v0(want, level).drop("source_start", "median", "history")
        assert same(store.read(f"{level}_data_forecast"), said), level
        props = store.read(f"{level}_prop")
        closed = want.where(F.col("slice_date") < F.lit(props.agg(F.max("through")).first()[0]))
        assert same(props, baselines(closed, level).drop("total")), level


def test_sums_on_the_stream_are_exact():
    import numpy as np

    from wattfold.streaming.device_clock import sums_of

    rng = np.random.default_rng(1)
    start = rng.integers(0, 3, 30000) * 60
    whole, part = rng.integers(-(10**12), 10**12, 30000), rng.integers(0, 10**15, 30000)
    got: dict[int, int] = {}
    for s, units, _ in sums_of(start, whole, part):
        got[s] = got.get(s, 0) + units
    want = {int(s): sum(int(w) * 10**15 + int(p) for w, p in zip(whole[start == s], part[start == s])) for s in set(start)}
    assert got == want


def test_a_silent_device_is_closed(monkeypatch):
    from wattfold.streaming.device_clock import DeviceClock

    class Value:
        held = None
        exists = lambda self: self.held is not None
        get = lambda self: self.held

        def update(self, value):
            self.held = value

    class Map(dict):
        updateValue = dict.__setitem__
        getValue = dict.get
        removeKey = dict.pop

    class Handle:
        def __init__(self):
            self.timers = []

        def getValueState(self, *_):
            return Value()

        def getMapState(self, *_):
            return Map()

        registerTimer = lambda self, at: self.timers.append(at)

    class Now:
        def __init__(self, ms):
            self.getCurrentWatermarkInMs = lambda: ms

    import pandas as pd

    def given(heard_ms, *seconds):
        starts = [s // 60 * 60 for s in seconds]
        heard = pd.Timestamp(heard_ms, unit="ms", tz="UTC")
        return iter([pd.DataFrame({"timestamp": seconds, "start": starts, "whole": 1, "part": 0, "heard": heard})])

    handle, clock = Handle(), DeviceClock(1, 10, 30)
    clock.init(handle)
    key = (1, 2, 3)
    out = pd.concat(clock.handleInputRows(key, given(0, 6000, 6030, 6300), Now(0)))
    assert out["count"].tolist() == [2, 1] and handle.timers == [30 * 60_000]
    list(clock.handleInputRows(key, given(60_000, 6001), Now(0)))
    list(clock.handleExpiredTimer(key, Now(30 * 60_000), None))
    assert len(clock.open) == 2 and handle.timers[-1] == 31 * 60_000  # heard of since
    list(clock.handleExpiredTimer(key, Now(31 * 60_000), None))
    assert not clock.open
    out = pd.concat(clock.handleInputRows(key, given(32 * 60_000, 6002, 6301, 6400), Now(0)))
    assert out["late"].tolist() == [0, 1, 1]  # what was stored is not started anew


def test_only_open_slices_reach_the_state():
    """Of a day in one delivery, ten minutes and the one they began in are kept; what comes out does not change."""
    import pandas as pd

    from wattfold.streaming.device_clock import DeviceClock

    class Map(dict):
        updates = 0
        getValue = dict.get
        removeKey = dict.pop

        def updateValue(self, key, value):
            self.updates += 1
            self[key] = value

    class Handle:
        held = None
        getValueState = lambda self, *_: self
        getMapState = lambda self, *_: Map()
        exists = lambda self: self.held is not None
        get = lambda self: self.held
        registerTimer = lambda self, at: None

        def update(self, value):
            self.held = value

    def given(*seconds):
        starts = [s // 60 * 60 for s in seconds]
        heard = pd.Timestamp(0, unit="ms", tz="UTC")
        return iter([pd.DataFrame({"timestamp": seconds, "start": starts, "whole": 2, "part": 7, "heard": heard})])

    clock = DeviceClock(1, 10, 30)
    clock.init(Handle())
    out = pd.concat(clock.handleInputRows((1, 2, 3), given(*range(0, 86400, 60)), None))
    assert len(out) == 1440 and out["late"].sum() == 0
    assert clock.open.updates == len(clock.open) == 11
    # The next one adds to what is open, closes more of it, and is late for what was closed.
    out = pd.concat(clock.handleInputRows((1, 2, 3), given(85000, 86000, 86459, 87000), None))
    on_time = out[out["late"] == 0]
    assert dict(zip((at.timestamp() for at in on_time["slice_start"]), on_time["count"])) == {85980: 2, 86400: 1, 87000: 1}
    assert out["late"].sum() == 1 and sorted(k[0] for k in clock.open) == [86400, 87000]


def test_repeats_count_unless_dropped(spark, readings, tmp_path):
    from wattfold.sources.readings import drop_repeats
    from wattfold.streaming.device_clock import device_sums

    rows = readings(("2024-01-01T00:00:00", 10))
    feed = str(tmp_path / "feed")
    drop(rows, feed)
    drop(rows, feed)

    def counts(stream, name):
        query = (
            stream.writeStream.outputMode("append").format("memory").queryName(name)
            .trigger(availableNow=True).start()
        )
        query.awaitTermination()
        return spark.table(name).count()

    assert counts(messages_feed(spark, feed), "all_rows") == 2
    assert counts(drop_repeats(messages_feed(spark, feed), 600), "one_each") == 1
    assert device_sums(messages_feed(spark, feed), CONFIG).isStreaming
