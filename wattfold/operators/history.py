"""Histories of a slice: same day so far, everything so far, same index, weekly chain.

Each takes ``requests``, the slices asked about, and returns their history rows (the
requested slice is part of its own history). Rows come back per request, never for all
pairs of a series.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from wattfold import schemas
from wattfold.config import HOUSE
from wattfold.functions import slices as S

_WEEK = 7


def latest_slices(slices: DataFrame, level: str = HOUSE) -> DataFrame:
    """The newest slice of every series, as requests."""
    keys = schemas.series_keys(level)
    return slices.groupBy(*keys).agg(F.max("slice_start").alias("slice_start"))


def _asked(requests: DataFrame, level: str) -> DataFrame:
    keys = schemas.series_keys(level)
    at = S.slice_index(F.col("slice_start"), F.col("slice_gap"))
    return requests.select(
        *keys,
        F.col("slice_start").alias("request_start"),
        S.slice_date(F.col("slice_start")).alias("request_date"),
        at.alias("request_index"),
    )


def _history(slices: DataFrame, requests: DataFrame, level: str, *more) -> DataFrame:
    keys = schemas.series_keys(level)
    h, r = slices.alias("h"), _asked(requests, level).alias("r")
    on = [F.col(f"h.{k}") == F.col(f"r.{k}") for k in keys]
    on.append(F.col("h.slice_start") <= F.col("r.request_start"))
    return h.join(r, [*on, *more]).select(
        *[F.col(f"h.{k}") for k in keys],
        "r.request_start",
        "h.slice_start",
        "h.slice_date",
        "h.slice_index",
        "h.avg",
    )


def history_same_day(slices: DataFrame, requests: DataFrame, level: str = HOUSE) -> DataFrame:
    return _history(slices, requests, level, F.col("h.slice_date") == F.col("r.request_date"))


def history_all(slices: DataFrame, requests: DataFrame, level: str = HOUSE) -> DataFrame:
    return _history(slices, requests, level)


def history_same_index(slices: DataFrame, requests: DataFrame, level: str = HOUSE) -> DataFrame:
    return _history(slices, requests, level, F.col("h.slice_index") == F.col("r.request_index"))


def weekly_chains(slices: DataFrame, level: str = HOUSE) -> DataFrame:
    """Each slice with its place in the unbroken run of weeks it belongs to.

    ``chain`` names the run and ``chain_week`` counts from 1 at its oldest slice, so a
    slice's weekly history is the ``chain_week`` slices of its chain up to it.
    """
    days = F.unix_date("slice_date")
    week = F.floor(days / _WEEK).cast("int")
    same_slot = [*schemas.series_keys(level), "slice_index", "_weekday"]
    numbered = slices.withColumns({"_weekday": F.pmod(days, F.lit(_WEEK)), "_week": week}).withColumn(
        "_nth", F.row_number().over(Window.partitionBy(*same_slot).orderBy("_week"))
    )
    placed = numbered.withColumn("chain", F.col("_week") - F.col("_nth"))
    place = Window.partitionBy(*same_slot, "chain").orderBy("_week")
    return placed.withColumn("chain_week", F.row_number().over(place)).drop("_week", "_nth")


def history_weekly(slices: DataFrame, requests: DataFrame, level: str = HOUSE) -> DataFrame:
    """Same weekday and index, week by week back until the first missing one."""
    keys = schemas.series_keys(level)
    chained = weekly_chains(slices, level)
    asked = chained.join(requests.select(*keys, "slice_start"), [*keys, "slice_start"], "left_semi").select(
        *keys,
        "slice_index",
        "_weekday",
        "chain",
        F.col("chain_week").alias("_asked_week"),
        F.col("slice_start").alias("request_start"),
    )
    back = chained.join(asked, [*keys, "slice_index", "_weekday", "chain"])
    return back.where(F.col("chain_week") <= F.col("_asked_week")).select(
        *keys,
        "request_start",
        "slice_start",
        "slice_date",
        "slice_index",
        "avg",
        (F.col("_asked_week") - F.col("chain_week")).alias("weeks_back"),
    )
