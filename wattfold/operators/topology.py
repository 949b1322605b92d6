"""Which gaps, entities and dates the stored slices cover."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from wattfold import schemas
from wattfold.config import DEVICE, HOUSE, HOUSEHOLD
from wattfold.functions import slices as S


def meta_gaps(house: DataFrame) -> DataFrame:
    return house.select("slice_gap").distinct().orderBy("slice_gap")


def _date_parts(text: str):
    d = F.col("slice_date")
    return [
        S.year_text(d).alias("year"),
        S.month_text(d).alias("month"),
        S.day_text(d).alias("day"),
        S.date_label(d).alias(text),
    ]


def _entity_dates(slices: DataFrame, level: str) -> DataFrame:
    return slices.select(*schemas.ids(level), "slice_date").distinct()


def meta_dates(slices: DataFrame, level: str) -> DataFrame:
    """The dates each entity has slices on, in date order."""
    dates = _entity_dates(slices, level).select(*schemas.ids(level), *_date_parts("date_text"))
    return dates.orderBy("date_text", *schemas.ids(level))


def meta_tree(device: DataFrame) -> DataFrame:
    """The tree of houses, households and devices with the dates of each, one row a node.

    A row names its parent and lists its own dates, at most one entry per calendar day.
    The tree is left in rows because nesting all devices of a house into one value would
    put the largest house into one task; ``nest_household`` builds the nested form below
    one household.
    """
    # Parents' dates come from the devices' distinct dates, so slices are scanned once.
    device_dates = _entity_dates(device, DEVICE)
    path = [F.col(c) for c in schemas.ids(DEVICE)]
    levels = {DEVICE: 3, HOUSEHOLD: 2, HOUSE: 1}
    nodes = device_dates.select(
        "slice_date",
        F.explode(
            F.array(
                *[
                    F.struct(
                        F.lit(level).alias("level"),
                        S.entity_key(*path[:depth]).alias("node"),
                        S.entity_key(*path[: depth - 1]).alias("parent"),
                    )
                    for level, depth in levels.items()
                ]
            )
        ).alias("n"),
    )
    listed = nodes.groupBy("n.level", "n.node", "n.parent").agg(
        F.sort_array(F.collect_set(F.struct(*_date_parts("text")))).alias("dates")
    )
    return listed.select("level", "node", "parent", "dates")


def nest_household(device: DataFrame, house_id: int, household_id: int) -> DataFrame:
    """One household's devices as a map from device to its dates."""
    own = device.where((F.col("house_id") == house_id) & (F.col("household_id") == household_id))
    dates = (
        _entity_dates(own, DEVICE)
        .groupBy(*schemas.ids(DEVICE))
        .agg(F.sort_array(F.collect_list(F.struct(*_date_parts("text")))).alias("dates"))
    )
    return dates.groupBy("house_id", "household_id").agg(
        F.map_from_entries(F.collect_list(F.struct("device_id", "dates"))).alias("devices")
    )
