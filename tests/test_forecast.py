import random
from datetime import datetime, timedelta
from statistics import median

import pytest
from pyspark.sql import functions as F

from wattfold.operators import forecast as fc
from wattfold.operators import history as H


def by_source(df):
    rows = df.select(
        F.col("source_start").cast("string").alias("source"),
        F.col("slice_start").cast("string").alias("target"),
        "avg",
        "median",
        "history",
    ).collect()
    return {r.source: (r.target, r.avg, r.median, r.history) for r in rows}


def test_v0_takes_the_median_at_the_targets_time_of_day(slices):
    df = slices(
        "house", 60,
        ("2024-01-01 05:00:00", 10), ("2024-01-02 05:00:00", 30), ("2024-01-03 05:00:00", 20),
        ("2024-01-04 03:00:00", 8), ("2024-01-03 03:00:00", 6), ("2024-01-01 03:00:00", 5),
    )
    got = by_source(fc.forecast_v0(df, "house"))
    assert got["2024-01-04 03:00:00"] == ("2024-01-04 05:00:00", 14, 20, 3)  # odd
    assert got["2024-01-03 03:00:00"] == ("2024-01-03 05:00:00", 13, 20, 2)  # even
    assert got["2024-01-01 03:00:00"] == ("2024-01-01 05:00:00", 5, 0, 0)  # none


@pytest.mark.parametrize("level", ["device", "household"])
def test_odd_median_works_below_house_level(slices, level):
    df = slices(level, 60, ("2024-01-01 02:00:00", 10), ("2024-01-02 00:00:00", 4))
    assert by_source(fc.forecast_v0(df, level))["2024-01-02 00:00:00"][1:] == (7, 10, 1)


def test_targets_roll_over_midnight_and_year(slices):
    df = slices("house", 60, ("2023-12-31 23:00:00", 4), ("2023-12-31 01:00:00", 10))
    # Not the start of the same day: the target is 01:00 on January 1st.
    assert by_source(fc.forecast_v0(df, "house"))["2023-12-31 23:00:00"] == ("2024-01-01 01:00:00", 7, 10, 1)


def test_history_in_another_month_counts(slices):
    df = slices("house", 60, ("2023-12-30 02:00:00", 10), ("2024-01-05 00:00:00", 4))
    assert by_source(fc.forecast_v0(df, "house"))["2024-01-05 00:00:00"][2] == 10


def test_half_day_gaps_do_not_count_the_source_itself(slices):
    df = slices("house", 720, ("2024-01-01 00:00:00", 10), ("2024-01-02 00:00:00", 4))
    got = by_source(fc.forecast_v0(df, "house"))
    assert got["2024-01-02 00:00:00"] == ("2024-01-03 00:00:00", 7, 10, 1)


@pytest.fixture(scope="module")
def walk():
    rng = random.Random(7)
    start = datetime(2024, 1, 1)
    return [
        (str(start + timedelta(hours=6 * i)), rng.choice([0, 1.5, 2, 7.25, 9]), house)
        for house in (0, 1)
        for i in range(120)
        if rng.random() < 0.8
    ]


def brute(rows, pick):
    """Forecasts from the definition, with ``pick`` choosing the older rows that count."""
    out = {}
    for when, avg, house in rows:
        now = datetime.fromisoformat(when)
        older = [(datetime.fromisoformat(w), a) for w, a, h in rows if h == house and datetime.fromisoformat(w) < now]
        past = pick(older, now)
        m = median(past) if past else 0
        out[(house, when)] = ((avg + m) / 2 if m > 0 else avg, m, len(past))
    return out


def weekly(older, now):
    found, at = dict(older), now - timedelta(weeks=1)
    past = []
    while at in found:
        past.append(found[at])
        at -= timedelta(weeks=1)
    return past


PICKS = {
    "v0": lambda older, now: [a for w, a in older if (now + timedelta(hours=12)).time() == w.time()],
    "v1": lambda older, now: [a for _, a in older],
    "v2": weekly,
    "v3": lambda older, now: [a for w, a in older if w.time() == now.time()],
}


@pytest.mark.parametrize("version", list(PICKS))
def test_versions_against_brute_force(slices, walk, version):
    said = fc.FORECASTS[version](slices("house", 360, *walk), "house")
    got = {
        (r.house_id, r.source): (r.avg, r.median, r.history)
        for r in said.select("house_id", F.col("source_start").cast("string").alias("source"), "avg", "median", "history").collect()
    }
    want = brute(walk, PICKS[version])
    assert got.keys() == want.keys()
    for key, value in want.items():
        assert got[key] == pytest.approx(value)


@pytest.mark.parametrize("version", list(PICKS))
def test_no_forecast_looks_ahead(slices, walk, version):
    cut = "2024-01-20 00:00:00"
    changed = [(w, a if w < cut else a + 100, h) for w, a, h in walk]

    def early(rows):
        said = fc.FORECASTS[version](slices("house", 360, *rows), "house")
        kept = said.where(F.col("source_start") < F.lit(cut).cast("timestamp"))
        return {tuple(r) for r in kept.select("house_id", "slice_start", "avg").collect()}

    assert early(walk) == early(changed)


def random_walk(days, seed=5, rare=0.9):
    """One series a day for very many days, with equal values, zeros and gaps."""
    rng = random.Random(seed)
    kinds = (lambda: 0.0, lambda: 7.25, lambda: rng.random(), lambda: rng.lognormvariate(3, 2), lambda: -rng.random())
    return [(d, rng.choice(kinds)()) for d in range(days) if rng.random() < rare]


def medians_of(spark, rows, chunk=None, most=1 << 15):
    from wattfold.operators.medians import running_medians

    df = spark.createDataFrame([(1, d, v) for d, v in rows], "series int, _day int, _past double")
    if chunk:
        df = df.withColumn("_part", F.floor(F.col("_day") / chunk))
    got = running_medians(df, ["series"], "_day", F.lit(True), most, "_part" if chunk else None)
    return {r["_day"]: (r["median"], r["history"]) for r in got.collect()}


@pytest.mark.parametrize("chunk", [None, 40])
@pytest.mark.parametrize("few", [0, 64])
def test_running_medians_of_long_series(spark, monkeypatch, chunk, few):
    from wattfold.operators import medians

    monkeypatch.setattr(medians, "FEW", few)
    rows = random_walk(400)
    values = [v for _, v in rows]
    want = {d: (median(values[:i]) if i else None, i) for i, (d, _) in enumerate(rows)}
    got = medians_of(spark, rows, chunk)
    assert got.keys() == want.keys()
    for day, (value, history) in want.items():
        assert got[day][1] == history
        assert got[day][0] == (None if value is None else pytest.approx(value, rel=1e-12))


@pytest.mark.parametrize("chunk", [None, 10])
def test_a_series_that_is_too_long_is_an_error(spark, chunk):
    with pytest.raises(Exception, match="longer than most"):
        medians_of(spark, [(d, float(d)) for d in range(100)], chunk, most=32)


def test_medians_need_no_python(slices, walk):
    df = slices("house", 360, *walk)
    for forecast in fc.FORECASTS.values():
        plan = forecast(df, "house")._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan.replace("Scan ExistingRDD", "") and "Pandas" not in plan


def test_v1_deals_a_series_over_tasks(slices, walk):
    plan = fc.forecast_v1(slices("house", 360, *walk), "house")._jdf.queryExecution().executedPlan().toString()
    dealt = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert any("slice_date" in line for line in dealt) and any("_node" in line for line in dealt)


def hist(df, request, find):
    asked = df.where(F.col("slice_start") == F.lit(request).cast("timestamp"))
    rows = find(df, asked).select(F.col("slice_start").cast("string").alias("s")).collect()
    return sorted(r.s for r in rows)


def test_histories(slices):
    times = [
        "2024-01-01 05:00:00", "2024-01-08 05:00:00", "2024-01-15 04:00:00", "2024-01-15 05:00:00",
        "2024-01-15 06:00:00", "2024-01-16 05:00:00",
    ]
    df = slices("house", 60, *[(t, 1) for t in times], ("2024-01-15 05:00:00", 1, 9))
    now = "2024-01-15 05:00:00"
    df0 = df.where("house_id = 0")
    assert hist(df0, now, H.history_same_day) == times[2:4]
    assert hist(df0, now, H.history_all) == times[:4]
    assert hist(df0, now, H.history_same_index) == [times[0], times[1], times[3]]
    assert hist(df0, now, H.history_weekly) == [times[0], times[1], times[3]]
    assert hist(df, now, H.history_all) == sorted([*times[:4], now])  # house 9 has its own


def test_weekly_history_stops_at_the_first_missing_week(slices):
    df = slices("house", 60, *[(f"2024-01-{d:02d} 05:00:00", 1) for d in (1, 15, 22, 29)])
    assert hist(df, "2024-01-29 05:00:00", H.history_weekly) == [f"2024-01-{d} 05:00:00" for d in (15, 22, 29)]
    weeks = {r.slice_date.day: r.chain_week for r in H.weekly_chains(df).collect()}
    assert weeks == {1: 1, 15: 1, 22: 2, 29: 3}
