"""Running min / average / max of a series; slices without load do not count."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from wattfold import schemas
from wattfold.functions import numeric, slices as S
from wattfold.operators.running import running_totals


def _loaded() -> Column:
    return F.nullif(F.col("avg"), F.lit(0.0))


def _partials() -> dict[str, tuple[str, Column]]:
    return {
        "min": ("min", _loaded()),
        "max": ("max", _loaded()),
        "total": ("sum", numeric.exact(_loaded())),
        "count": ("count", _loaded()),
    }


def _seeded(col, seed_zero: bool, pick):
    # The optional zero seed keeps the minimum at 0 for loads that are never negative.
    return pick(col, F.lit(0.0)) if seed_zero else col


def _mean(total, count):
    return numeric.safe_mean(total.cast("double"), count)


def baselines(slices: DataFrame, level: str, seed_zero: bool = False) -> DataFrame:
    """One row per entity and gap: min, avg, max and count over all its slices with load."""
    keys = schemas.series_keys(level)
    totals = slices.groupBy(*keys).agg(
        F.min(_loaded()).alias("min"),
        F.max(_loaded()).alias("max"),
        F.sum(numeric.exact(_loaded())).alias("total"),
        F.count(_loaded()).alias("count"),
    )
    return totals.select(
        *keys,
        F.coalesce(_seeded(F.col("min"), seed_zero, F.least), F.lit(0.0)).alias("min"),
        _mean(F.col("total"), F.col("count")).alias("avg"),
        F.coalesce(F.col("max"), F.lit(0.0)).alias("max"),
        F.col("total"),
        F.col("count"),
    )


def merge_baselines(old: DataFrame, new: DataFrame, level: str) -> DataFrame:
    """Two sets of baselines over disjoint slices as one."""
    keys = schemas.series_keys(level)
    loaded = F.col("count") > 0
    both = old.select(*keys, "min", "max", "total", "count").unionByName(
        new.select(*keys, "min", "max", "total", "count")
    )
    totals = both.groupBy(*keys).agg(
        F.min(F.when(loaded, F.col("min"))).alias("min"),
        F.max(F.when(loaded, F.col("max"))).alias("max"),
        F.sum("total").cast("decimal(38,15)").alias("total"),
        F.sum("count").alias("count"),
    )
    return totals.select(
        *keys,
        F.coalesce("min", F.lit(0.0)).alias("min"),
        _mean(F.col("total"), F.col("count")).alias("avg"),
        F.coalesce("max", F.lit(0.0)).alias("max"),
        "total",
        "count",
    )


def running_baseline(
    slices: DataFrame, level: str, seed_zero: bool = False, start: DataFrame | None = None
) -> DataFrame:
    """Each slice with the baseline as it stood before it: evaluate first, update after.

    ``start`` carries the baselines of slices older than the given ones.
    """
    keys = schemas.series_keys(level)
    if start is not None:
        loaded = F.col("count") > 0
        start = start.withColumns(
            {"min": F.when(loaded, F.col("min")), "max": F.when(loaded, F.col("max"))}
        )
    series = slices.select(*schemas.slice_keys(level), "slice_date", "avg")
    out = running_totals(series, keys, "slice_start", _partials(), start=start)
    return S.with_slice_parts(out).withColumns(
        {
            "prior_min": F.coalesce(_seeded(F.col("min"), seed_zero, F.least), F.lit(0.0)),
            "prior_avg": _mean(F.col("total"), F.col("count")),
            "prior_max": F.coalesce("max", F.lit(0.0)),
            "prior_count": F.col("count"),
        }
    ).drop("min", "max", "total", "count")


def attach_baseline(slices: DataFrame, stored: DataFrame, level: str) -> DataFrame:
    """Each slice with its series' stored baseline, all zero where none is stored."""
    keys = schemas.series_keys(level)
    known = stored.select(
        *keys,
        F.col("min").alias("prior_min"),
        F.col("avg").alias("prior_avg"),
        F.col("max").alias("prior_max"),
        F.col("count").alias("prior_count"),
    )
    out = slices.drop("value", "count").join(known, keys, "left")
    filled = {c: F.coalesce(c, F.lit(0.0)) for c in ("prior_min", "prior_avg", "prior_max")}
    return out.withColumns({**filled, "prior_count": F.coalesce("prior_count", F.lit(0))})
