"""Scores of forecasts, statistics of a series, and actual next to forecast."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from wattfold import schemas
from wattfold.config import HOUSE
from wattfold.functions import slices as S
from wattfold.operators.running import running_position


def forecast_score(actual: DataFrame, forecasts: DataFrame, versions=("v0",)) -> DataFrame:
    """Per version and gap: sample statistics over actual and forecast loads together, and
    the mean squared error of the two after scaling both by those statistics.
    """
    keys = [*schemas.slice_keys(HOUSE), "version"]
    seen = actual.select(
        *schemas.slice_keys(HOUSE),
        F.col("avg").alias("actual"),
        F.explode(F.array(*[F.lit(v) for v in versions])).alias("version"),
    )
    said = forecasts.where(F.col("version").isin(*versions)).select(*keys, F.col("avg").alias("forecast"))
    pairs = seen.join(said, keys, "full")
    # The squared error rides on the actual's row, so one grouped pass yields everything.
    error = (F.col("actual") - F.col("forecast")) ** 2
    samples = pairs.select(
        "version",
        "slice_gap",
        F.explode(
            F.array(
                F.struct(F.col("actual").alias("x"), error.alias("error"), F.lit(False).alias("is_forecast")),
                F.struct(
                    F.col("forecast").alias("x"),
                    F.lit(None).cast("double").alias("error"),
                    F.lit(True).alias("is_forecast"),
                ),
            )
        ).alias("s"),
    ).where(F.col("s.x").isNotNull())
    scored = samples.groupBy("version", "slice_gap").agg(
        F.count_if(F.col("s.is_forecast")).alias("count"),
        F.avg("s.x").alias("mean"),
        F.var_samp("s.x").alias("variance"),
        F.stddev_samp("s.x").alias("standard_deviation"),
        F.avg("s.error").alias("_error"),
    )
    return scored.withColumn("mse", F.col("_error") / F.nullif("variance", F.lit(0.0))).drop("_error")


def daily_moments(actual: DataFrame, forecasts: DataFrame, versions) -> DataFrame:
    """What each day adds to ``forecast_score``: per version, gap and day, in a form that merges.

    ``squares`` are the squared deviations of the day's actual and forecast loads from their
    ``mean``, ``error`` is the sum of squared errors over the ``pairs`` that have both.
    """
    keys = [*schemas.slice_keys(HOUSE), "slice_date", "version"]
    seen = actual.select(
        *schemas.slice_keys(HOUSE),
        "slice_date",
        F.col("avg").alias("actual"),
        F.explode(F.array(*[F.lit(v) for v in versions])).alias("version"),
    )
    said = forecasts.where(F.col("version").isin(*versions)).select(*keys, F.col("avg").alias("forecast"))
    both = seen.join(said, keys, "full").withColumn("x", F.explode(F.array_compact(F.array("actual", "forecast"))))
    paired = F.col("actual").isNotNull() & (F.col("forecast").isNotNull())
    # Each pair comes twice, once for either load.
    return both.groupBy("version", "slice_gap", "slice_date").agg(
        (F.count("*") - F.count_if(F.col("forecast").isNull()) - F.count_if(paired) / 2).cast("bigint").alias("_"),
        F.count("x").alias("count"),
        F.avg("x").alias("mean"),
        (F.var_pop("x") * F.count("x")).alias("squares"),
        (F.count_if(paired) / 2).cast("bigint").alias("pairs"),
        (F.sum(F.when(paired, (F.col("actual") - F.col("forecast")) ** 2)) / 2).alias("error"),
    ).withColumnRenamed("_", "forecasts")


def merged_scores(moments: DataFrame) -> DataFrame:
    """Scores of all days from the moments of each, as ``forecast_score`` would give them."""
    keys = ["version", "slice_gap"]
    whole = moments.groupBy(*keys).agg((F.sum(F.col("mean") * F.col("count")) / F.sum("count")).alias("_mean"))
    # Deviations of a day count from its own mean, plus how far that lies from the common one.
    apart = F.col("squares") + F.col("count") * (F.col("mean") - F.col("_mean")) ** 2
    merged = moments.join(whole, keys).groupBy(*keys).agg(
        F.sum("forecasts").alias("forecasts"),
        F.sum("count").alias("_n"),
        F.first("_mean").alias("mean"),
        F.sum(apart).alias("_squares"),
        (F.sum("error") / F.nullif(F.sum("pairs"), F.lit(0))).alias("_error"),
    )
    variance = F.col("_squares") / F.nullif(F.col("_n") - 1, F.lit(0))
    return merged.select(
        "slice_gap",
        F.col("forecasts").alias("count"),
        "mean",
        variance.alias("variance"),
        F.sqrt(variance).alias("standard_deviation"),
        (F.col("_error") / F.nullif(variance, F.lit(0.0))).alias("mse"),
        "version",
    )


def series_stats(series: DataFrame, keys: list[str]) -> DataFrame:
    """Count, mean and population variance of each displayed series."""
    return series.groupBy(*keys).agg(
        F.count("avg").alias("count"),
        F.avg("avg").alias("mean"),
        F.var_pop("avg").alias("variance"),
        F.stddev_pop("avg").alias("standard_deviation"),
    )


def actual_vs_forecast(
    actual: DataFrame, forecast: DataFrame, level: str = HOUSE, version: str = "v0"
) -> DataFrame:
    """Both series on one axis: every slice either has, 0 where one is missing, in order."""
    keys = schemas.slice_keys(level)
    if "version" in forecast.columns:
        forecast = forecast.where(F.col("version") == version)
    both = actual.select(*keys, F.col("avg").alias("actual")).join(
        forecast.select(*keys, F.col("avg").alias("forecast")), keys, "full"
    )
    filled = both.withColumns(
        {"actual": F.coalesce("actual", F.lit(0.0)), "forecast": F.coalesce("forecast", F.lit(0.0))}
    )
    return running_position(
        S.with_slice_parts(filled), schemas.series_keys(level), "slice_start", "position"
    )
