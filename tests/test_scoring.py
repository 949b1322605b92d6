import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from wattfold.operators.stats import daily_moments, forecast_score, merged_scores
from wattfold.plans.scoring import score_stored
from wattfold.sinks.tables import TableStore

SCORE = ["count", "mean", "variance", "standard_deviation", "mse"]


def loads(slices, seed, days=range(1, 10), base=1000.0):
    rng = random.Random(seed)
    rows = [
        (f"2024-01-{d:02d} {h:02d}:00:00", base + rng.random(), house)
        for d in days for h in (0, 5, 11) for house in (0, 1) if rng.random() < 0.8
    ]
    return slices("house", 60, *rows)


def said(df, *versions):
    parts = [df.withColumns({"avg": F.col("avg") + i, "version": F.lit(v)}) for i, v in enumerate(versions)]
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def by_version(df):
    return {r["version"]: [r[c] for c in SCORE] for r in df.collect()}


def test_scores_merge_from_days(slices):
    """Loads far from zero and close together, where sums of squares would lose their digits."""
    actual, forecasts = loads(slices, 1, base=1e8), said(loads(slices, 2, base=1e8), "v0", "v1")
    want = by_version(forecast_score(actual, forecasts, ("v0", "v1")))
    got = by_version(merged_scores(daily_moments(actual, forecasts, ("v0", "v1"))))
    assert got.keys() == want.keys()
    for version, row in want.items():
        assert got[version] == pytest.approx(row, rel=1e-6)


def test_only_changed_days_are_read(spark, slices, tmp_path):
    store = TableStore(spark, str(tmp_path / "tables"))
    score_stored(store)
    actual, forecasts = loads(slices, 3), said(loads(slices, 4), "v0")
    store.upsert("house_data", actual)
    store.upsert("house_data_forecast", forecasts)
    score_stored(store)
    assert by_version(store.read("forecast_meta_data")) == {
        "v0": pytest.approx(by_version(forecast_score(actual, forecasts))["v0"])
    }
    changed = loads(slices, 5, days=(9,))
    store.upsert("house_data", changed)
    asked = []
    read = store.read
    store.read = lambda name, first=None, last=None: asked.append((name, first)) or read(name, first, last)
    score_stored(store, first=date(2024, 1, 9))
    assert ("house_data", date(2024, 1, 9)) in asked and ("house_data_forecast", date(2024, 1, 9)) in asked
    now = read("house_data")
    assert by_version(read("forecast_meta_data"))["v0"] == pytest.approx(by_version(forecast_score(now, forecasts))["v0"])
