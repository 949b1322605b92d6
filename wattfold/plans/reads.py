"""The reads a dashboard makes: filtered slices and forecasts, weeks, pages, exports."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from wattfold import schemas
from wattfold.config import DEVICE, HOUSE, HOUSEHOLD, MINUTES_PER_DAY, check_gaps
from wattfold.functions import slices as S
from wattfold.operators.stats import series_stats

ANY = "*"
DEFAULT_VERSION = "v0"


def _given(value) -> bool:
    return value is not None and value != ANY


def level_for(household_id=None, device_id=None) -> str:
    """House rows unless a household is named, household rows unless a device is too."""
    if not _given(household_id):
        return HOUSE
    return DEVICE if _given(device_id) else HOUSEHOLD


def _conditions(level, house_id, household_id, device_id, year, month, day, slice_gap, slice_index):
    date = F.col("slice_date")
    tests = {
        "house_id": (F.col("house_id"), house_id),
        "year": (F.year(date), year),
        "month": (F.month(date), month),
        "day": (F.dayofmonth(date), day),
        "slice_gap": (F.col("slice_gap"), slice_gap),
        "slice_index": (F.col("slice_index"), slice_index),
    }
    if level != HOUSE:
        tests["household_id"] = (F.col("household_id"), household_id)
    if level == DEVICE:
        tests["device_id"] = (F.col("device_id"), device_id)
    return [col == F.lit(int(want)) for col, want in tests.values() if _given(want)]


def query_slices(
    tables: Mapping[str, DataFrame],
    house_id=None,
    household_id=None,
    device_id=None,
    year=None,
    month=None,
    day=None,
    slice_gap=None,
    slice_index=None,
) -> DataFrame:
    """Slices of the level the ids ask for; every other filter applies only if given."""
    level = level_for(household_id, device_id)
    tests = _conditions(
        level, house_id, household_id, device_id, year, month, day, slice_gap, slice_index
    )
    rows = reduce(lambda df, test: df.where(test), tests, tables[level])
    return rows.select(*schemas.ids(level), "slice_gap", "slice_start", "slice_date", "slice_index", "avg")


def query_forecast(tables: Mapping[str, DataFrame], version: str = DEFAULT_VERSION, **filters) -> DataFrame:
    """As ``query_slices``, over the forecasts of one version."""
    chosen = {level: df.where(F.col("version") == version) for level, df in tables.items()}
    return query_slices(chosen, **filters)


def _in_week(rows: DataFrame, week: int) -> DataFrame:
    first = 1 + 7 * int(week)
    return rows.where(F.dayofmonth("slice_date").between(first, first + 6))


def query_week(tables, week: int, **filters) -> DataFrame:
    """Days 1-7 of the month for week 0, 8-14 for week 1, and so on."""
    return _in_week(query_slices(tables, **filters), week)


def query_forecast_week(tables, week: int, version: str = DEFAULT_VERSION, **filters) -> DataFrame:
    return _in_week(query_forecast(tables, version, **filters), week)


def get_forecast_score(scores: DataFrame, version: str, slice_gap: int) -> DataFrame:
    if not version or not slice_gap:
        raise ValueError("both version and slice_gap are needed")
    return scores.where((F.col("version") == version) & (F.col("slice_gap") == int(slice_gap)))


def alerts_page(
    alert_rows: DataFrame, level: str, house_id=None, household_id=None, device_id=None, offset=0, limit=10
) -> DataFrame:
    """Newest alerts first. A finer id counts only where the coarser ones are given too."""
    rows = alert_rows
    for name, want in zip(schemas.ids(level), (house_id, household_id, device_id)):
        if not _given(want):
            break
        rows = rows.where(F.col(name) == F.lit(int(want)))
    raised = S.slice_end(F.col("slice_start"), F.col("slice_gap"))
    order = [raised.desc(), F.col("slice_gap"), *[F.col(c) for c in schemas.ids(level)], F.col("type")]
    return rows.orderBy(*order).offset(int(offset)).limit(int(limit))


def export_wide(series: DataFrame, gap: int, level: str = HOUSE) -> DataFrame:
    """One row per entity and day with a column per slice, then the day's statistics.

    The columns are the day's slices of width ``gap``, known without looking at the data.
    """
    (gap,) = check_gaps([gap])
    keys = [*schemas.ids(level), "slice_date"]
    day = series.where(F.col("slice_gap") == gap)
    labels = [
        "{:02d}:{:02d}->{:02d}:{:02d}".format(*divmod(m, 60), *divmod(m + gap, 60))
        for m in range(0, MINUTES_PER_DAY, gap)
    ]
    labelled = day.select(*keys, S.clock_range(F.col("slice_index"), F.lit(gap)).alias("label"), "avg")
    wide = labelled.groupBy(*keys).pivot("label", labels).agg(F.first("avg"))
    return wide.join(series_stats(day, keys), keys)


def export_lines(wide: DataFrame, level: str = HOUSE) -> DataFrame:
    """The exported rows as the lines of a text file: header, values, statistics."""
    names = ["count", "mean", "variance", "standard_deviation"]
    # How the export names its statistics.
    titles = ["Count", "Mean", "Variance", "Standard deviation"]
    fixed = {*schemas.ids(level), "slice_date", *names}
    labels = [c for c in wide.columns if c not in fixed]
    date = S.date_label(F.col("slice_date"))

    def cell(c):
        return F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))

    header = F.concat_ws(",", F.lit(level.capitalize()), *[F.concat_ws(" ", date, F.lit(c)) for c in labels])
    values = F.concat_ws(",", S.entity_key(*[F.col(c) for c in schemas.ids(level)]), *[cell(c) for c in labels])
    stats = [
        F.concat_ws(",", F.lit(title), F.format_string("%.3f", F.col(n).cast("double")) if n != "count" else cell(n))
        for n, title in zip(names, titles)
    ]
    return wide.select(F.explode(F.array(header, values, *stats)).alias("value"))


def write_export(wide: DataFrame, path: str, level: str = HOUSE) -> None:
    export_lines(wide, level).write.mode("overwrite").text(path)
