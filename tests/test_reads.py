import pytest
from pyspark.sql import functions as F

from wattfold.operators.stats import actual_vs_forecast, forecast_score, series_stats
from wattfold.operators.topology import meta_dates, meta_tree, nest_household
from wattfold.plans import reads


def forecasts(df, version="v0"):
    return df.withColumn("version", F.lit(version))


def test_score_keeps_houses_apart(slices):
    actual = slices("house", 60, ("2024-01-01 00:00:00", 10), ("2024-01-01 00:00:00", 20, 1), ("2024-01-01 01:00:00", 30))
    said = forecasts(slices("house", 60, ("2024-01-01 00:00:00", 14), ("2024-01-01 00:00:00", 18, 1), ("2024-01-01 05:00:00", 1)))
    row = forecast_score(actual, said).first()
    values = [10, 20, 30, 14, 18, 1]
    mean = sum(values) / 6
    variance = sum((v - mean) ** 2 for v in values) / 5
    assert (row["count"], row.version, row.slice_gap) == (3, "v0", 60)
    assert row.mean == pytest.approx(mean) and row.variance == pytest.approx(variance)
    assert row.standard_deviation == pytest.approx(variance**0.5)
    assert row.mse == pytest.approx(((10 - 14) ** 2 + (20 - 18) ** 2) / 2 / variance)


def test_score_without_a_match_has_no_error(slices):
    row = forecast_score(
        slices("house", 60, ("2024-01-01 00:00:00", 10)), forecasts(slices("house", 60, ("2024-01-01 05:00:00", 2)))
    ).first()
    assert row.mse is None and row["count"] == 1


def test_actual_next_to_forecast(slices):
    actual = slices("house", 60, ("2024-01-01 23:00:00", 10), ("2024-01-02 00:00:00", 20))
    said = slices("house", 60, ("2024-01-02 00:00:00", 5), ("2024-01-02 01:00:00", 6))
    rows = actual_vs_forecast(actual, said).orderBy("position").collect()
    assert [(r.position, r.slice_index, r.actual, r.forecast) for r in rows] == [
        (0, 23, 10, 0), (1, 0, 20, 5), (2, 1, 0, 6),
    ]


def test_series_stats_are_of_the_population(slices):
    row = series_stats(slices("house", 60, ("2024-01-01 00:00:00", 2), ("2024-01-01 01:00:00", 4)), ["house_id"]).first()
    assert (row["count"], row.mean, row.variance, row.standard_deviation) == (2, 3, 1, 1)


@pytest.fixture
def tables(slices):
    return {
        "house": slices("house", 60, ("2024-01-07 00:00:00", 1), ("2024-01-08 00:00:00", 2, 1), ("2024-02-08 05:00:00", 3)),
        "household": slices("household", 60, ("2024-01-07 00:00:00", 4, 0, 1), ("2024-01-07 00:00:00", 5, 0, 2)),
        "device": slices("device", 60, ("2024-01-07 00:00:00", 6, 0, 1, 1), ("2024-01-07 00:00:00", 7, 0, 1, 2)),
    }


def found(df):
    return sorted(r.avg for r in df.collect())


def test_level_choice_and_optional_filters(tables):
    q = reads.query_slices
    assert found(q(tables)) == found(q(tables, household_id="*")) == [1, 2, 3]
    assert found(q(tables, household_id=1)) == found(q(tables, household_id="1", device_id="*")) == [4]
    assert found(q(tables, household_id=1, device_id=2)) == [7]
    assert found(q(tables, house_id=0)) == [1, 3]
    assert found(q(tables, month="01")) == [1, 2]
    assert found(q(tables, house_id=0, year=2024, month=2, day=8, slice_gap=60, slice_index=5)) == [3]
    assert found(q(tables, slice_gap=1)) == []  # the gap counts without a house id too


def test_rows_keep_their_ids(tables):
    rows = reads.query_slices(tables, household_id=2).collect()
    assert [(r.house_id, r.household_id) for r in rows] == [(0, 2)]


def test_weeks_of_the_month(tables):
    assert found(reads.query_week(tables, 0, month=1)) == [1]
    assert found(reads.query_week(tables, 1)) == [2, 3]
    said = {k: forecasts(v, "v2") for k, v in tables.items()}
    assert found(reads.query_forecast_week(said, 1, version="v2")) == [2, 3]
    assert found(reads.query_forecast(said)) == []


def test_score_lookup_needs_both_arguments(spark):
    scores = spark.createDataFrame([("v0", 60), ("v0", 5)], "version string, slice_gap int")
    assert reads.get_forecast_score(scores, "v0", 5).count() == 1
    with pytest.raises(ValueError):
        reads.get_forecast_score(scores, "v0", None)


def test_alert_pages_run_newest_first(slices):
    times = [f"2024-01-01 {h:02d}:00:00" for h in range(15)]
    rows = slices("household", 60, *[(t, i, i % 2, i % 3) for i, t in enumerate(times)])
    rows = rows.withColumns({"type": F.lit(1), "value": F.col("avg")})

    def page(**kw):
        return [int(r.value) for r in reads.alerts_page(rows, "household", **kw).collect()]

    assert page() == list(range(14, 4, -1))
    assert page(offset=10) == [4, 3, 2, 1, 0]
    assert page(house_id=1, limit=3) == [13, 11, 9]
    assert page(house_id=1, household_id=0) == [9, 3]
    assert page(household_id=0, limit=2) == [14, 13]  # no house given: the household is not looked at


def test_export(slices):
    wide = reads.export_wide(slices("house", 720, ("2024-01-01 12:00:00", 3), ("2024-01-02 00:00:00", 1), ("2024-01-02 12:00:00", 2)), 720)
    assert wide.columns[:4] == ["house_id", "slice_date", "00:00->12:00", "12:00->24:00"]
    first, second = wide.orderBy("slice_date").collect()
    assert first[2] is None and first[3] == 3 and first["count"] == 1
    assert (second["mean"], second["variance"]) == (1.5, 0.25)
    lines = [r.value for r in reads.export_lines(wide.where("count = 2")).collect()]
    assert lines == [
        "House,2024/01/02 00:00->12:00,2024/01/02 12:00->24:00",
        "0,1.0,2.0", "Count,2", "Mean,1.500", "Variance,0.250", "Standard deviation,0.500",
    ]


def test_topology(slices):
    df = slices("device", 60, ("2024-01-02 00:00:00", 1, 0, 1, 1), ("2024-01-01 05:00:00", 1, 0, 1, 1), ("2024-01-02 01:00:00", 1, 0, 1, 2))
    dates = [(r.device_id, r.date_text) for r in meta_dates(df, "device").collect()]
    assert dates == [(1, "2024/01/01"), (1, "2024/01/02"), (2, "2024/01/02")]
    tree = {(r.level, r.node, r.parent): [d.text for d in r.dates] for r in meta_tree(df).collect()}
    assert tree == {
        ("house", "0", ""): ["2024/01/01", "2024/01/02"],
        ("household", "0-1", "0"): ["2024/01/01", "2024/01/02"],
        ("device", "0-1-1", "0-1"): ["2024/01/01", "2024/01/02"],
        ("device", "0-1-2", "0-1"): ["2024/01/02"],
    }
    nested = nest_household(df, 0, 1).first().devices
    assert {k: [d.day for d in v] for k, v in nested.items()} == {1: ["01", "02"], 2: ["02"]}
