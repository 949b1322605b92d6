"""Forecasts two slices ahead: half the current load, half the median of its history.

The versions differ in the history they take: v0 the target's time of day on earlier days,
v1 everything before, v2 the weekly chain, v3 the source's own time of day. All of them
see only slices strictly older than the source slice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from wattfold import schemas
from wattfold.config import HOUSE
from wattfold.functions import slices as S
from wattfold.operators.history import weekly_chains
from wattfold.operators.medians import running_medians

AHEAD = 2

# How many values a median may look back on: one a day for 89 years, and for v1 two years of minutes.
MOST_DAYS = 1 << 15
MOST_SLICES = 1 << 20


def _blend(avg: Column, median: Column) -> Column:
    return F.when(median > 0, (avg + median) / 2).otherwise(avg)


def _as_forecast(rows: DataFrame, level: str, version: str) -> DataFrame:
    """Rows with ``slice_start, avg, median, history`` of the source, moved to the target."""
    median = F.coalesce("median", F.lit(0.0))
    target = rows.select(
        *schemas.ids(level),
        "slice_gap",
        F.col("slice_start").alias("source_start"),
        S.shift_slice(F.col("slice_start"), F.col("slice_gap"), AHEAD).alias("slice_start"),
        _blend(F.col("avg"), median).alias("avg"),
        median.alias("median"),
        F.col("history"),
        F.lit(version).alias("version"),
    )
    return S.with_slice_parts(target)


def forecast_v0(slices: DataFrame, level: str, sources: DataFrame | None = None) -> DataFrame:
    """``sources`` limits which slices are forecast from; by default all of them."""
    keys = schemas.series_keys(level)
    start = F.unix_seconds("slice_start")
    span = F.col("slice_gap") * 60

    def slot(seconds):
        return F.floor(F.pmod(seconds, F.lit(S.DAY_SECONDS)) / span).cast("int")

    if sources is not None:
        return _as_forecast(_median_of_joined(slices, sources, keys, start, slot, span), level, "v0")
    nothing = F.lit(None).cast("double")
    as_history = F.struct(slot(start).alias("_slot"), F.col("avg").alias("_past"), nothing.alias("_now"))
    as_request = F.struct(
        slot(start + AHEAD * span).alias("_slot"), nothing.alias("_past"), F.col("avg").alias("_now")
    )
    # Every slice is both: one pass over the input instead of a union of two.
    rows = slices.select(
        *[F.col(k) for k in keys],
        F.col("slice_start"),
        start.alias("_at"),
        F.explode(F.array(as_history, as_request)).alias("_r"),
    )
    rows = rows.select(*keys, "slice_start", "_at", "_r.*")
    found = running_medians(rows, [*keys, "_slot"], "_at", F.col("_now").isNotNull(), MOST_DAYS)
    return _as_forecast(found.withColumn("avg", F.col("_now")), level, "v0")


def _median_of_joined(slices, sources, keys, start, slot, span) -> DataFrame:
    """One grouped median per source; what is read grows with the sources times their days."""
    asked = sources.select(
        *keys, "slice_start", start.alias("_at"), "avg", slot(start + AHEAD * span).alias("_slot")
    )
    past = slices.select(*keys, slot(start).alias("_slot"), start.alias("_then"), F.col("avg").alias("_past"))
    same = [asked[k] == past[k] for k in [*keys, "_slot"]]
    matched = asked.join(past, [*same, past["_then"] < asked["_at"]], "left")
    return matched.groupBy(*[asked[k] for k in keys], "slice_start").agg(
        F.first("avg").alias("avg"),
        F.percentile("_past", F.lit(0.5)).alias("median"),
        F.count("_past").alias("history"),
    )


def forecast_v2(slices: DataFrame, level: str = HOUSE) -> DataFrame:
    chained = weekly_chains(slices, level).withColumn("_past", F.col("avg"))
    slot = [*schemas.series_keys(level), "slice_index", "_weekday", "chain"]
    return _as_forecast(running_medians(chained, slot, "chain_week", F.lit(True), MOST_DAYS), level, "v2")


def forecast_v3(slices: DataFrame, level: str = HOUSE) -> DataFrame:
    rows = slices.withColumns({"_past": F.col("avg"), "_day": F.unix_date("slice_date")})
    slot = [*schemas.series_keys(level), "slice_index"]
    return _as_forecast(running_medians(rows, slot, "_day", F.lit(True), MOST_DAYS), level, "v3")


def forecast_v1(slices: DataFrame, level: str = HOUSE, most: int = MOST_SLICES) -> DataFrame:
    """Median of the whole series so far, exact; counted a day at a time, so a series is spread over tasks.

    ``most`` bounds the slices of a series; each factor of 16 more costs another pass.
    """
    keys = schemas.series_keys(level)
    at = F.unix_seconds("slice_start").alias("_at")
    rows = slices.select(*keys, "slice_start", "slice_date", at, "avg", F.col("avg").alias("_past"))
    return _as_forecast(running_medians(rows, keys, "_at", F.lit(True), most, chunk="slice_date"), level, "v1")


FORECASTS = {"v0": forecast_v0, "v1": forecast_v1, "v2": forecast_v2, "v3": forecast_v3}
