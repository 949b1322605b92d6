"""Slice averages per device and their roll-up to household and house."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from wattfold import schemas
from wattfold.config import DEFAULT_GAPS, DEVICE, HOUSE, HOUSEHOLD, base_gap, block_gap, check_gaps
from wattfold.functions import numeric, slices as S
from wattfold.sources.readings import load_only

DEVICE_IDS = schemas.ids(DEVICE)


def _device_ids():
    return [F.col("house_id"), F.col("household_id"), F.col("plug_id").alias("device_id")]


def assign_slice(readings: DataFrame, gap: int) -> DataFrame:
    """Each reading with the one slice of width ``gap`` it falls into."""
    (gap,) = check_gaps([gap])
    placed = readings.withColumns(
        {"slice_gap": F.lit(gap), "slice_start": S.slice_start(F.col("timestamp"), F.lit(gap))}
    )
    return S.with_slice_parts(placed)


def multi_window(readings: DataFrame, gaps=DEFAULT_GAPS) -> DataFrame:
    """Each reading once per slice width.

    Useful to look at single readings; ``device_slices`` does not go through it, since it
    would aggregate every reading once per width.
    """
    fanned = readings.withColumn("slice_gap", F.explode(F.array(*[F.lit(g) for g in check_gaps(gaps)])))
    placed = fanned.withColumn("slice_start", S.slice_start(F.col("timestamp"), F.col("slice_gap")))
    return S.with_slice_parts(placed)


def base_slices(readings: DataFrame, gap: int = 1) -> DataFrame:
    """``(total, count)`` per device and base slice: the additive form everything rolls up from."""
    return (
        load_only(readings)
        .select(
            *_device_ids(),
            S.slice_start(F.col("timestamp"), F.lit(gap)).alias("slice_start"),
            numeric.exact(F.col("value")).alias("value"),
        )
        .groupBy(*DEVICE_IDS, "slice_start")
        .agg(F.sum("value").alias("total"), F.count(F.lit(1)).alias("count"))
    )


def rollup_base(base: DataFrame, gaps=DEFAULT_GAPS) -> DataFrame:
    """Device slices of every width from base slices.

    Base rows move once, hashed by device and by the block of time that is a multiple of
    every gap. All wider slices of a device lie inside one block, so no width needs
    another shuffle. Each block is walked in the order of time with one running sum: where a
    slice of some width ends, its sum is what was added since the last slice of that width
    ended. So a task sorts its base rows once and holds no table of slices, of which there
    may be as many as widths to every base row.
    """
    gaps = check_gaps(gaps)
    block = S.slice_start(F.unix_seconds("slice_start"), F.lit(block_gap(gaps)))
    placed = base.select(
        *DEVICE_IDS, block.alias("block"), F.unix_seconds("slice_start").alias("_at"), "total", "count"
    ).repartition(*[F.col(c) for c in DEVICE_IDS], F.col("block"))
    walk = Window.partitionBy(*DEVICE_IDS, "block").orderBy("_at")
    so_far = walk.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = walk.rowsBetween(Window.unboundedPreceding, -1)

    def place(at, gap):
        return F.floor(F.col(at) / F.lit(gap * 60))

    ends = {gap: F.col("_next").isNull() | (place("_next", gap) != place("_at", gap)) for gap in gaps}
    # At full precision a difference would give up a decimal place to make room.
    summed = placed.withColumns(
        {
            "_next": F.lead("_at").over(walk),
            "_sum": F.struct(
                F.sum("total").over(so_far).cast("decimal(37,15)").alias("total"),
                F.sum("count").over(so_far).alias("count"),
            ),
        }
    ).drop("total", "count")
    summed = summed.withColumns(
        {f"_last_{gap}": F.last(F.when(ends[gap], F.col("_sum")), ignorenulls=True).over(before) for gap in gaps}
    )
    nothing = {"total": F.lit(0).cast("decimal(37,15)"), "count": F.lit(0).cast("bigint")}

    def since(gap, name):
        return F.col(f"_sum.{name}") - F.coalesce(F.col(f"_last_{gap}.{name}"), nothing[name])

    made = [
        F.struct(
            F.lit(gap).alias("slice_gap"),
            S.slice_start(F.col("_at"), F.lit(gap)).alias("slice_start"),
            since(gap, "total").alias("total"),
            since(gap, "count").alias("count"),
        )
        for gap in gaps
    ]
    ended = F.array_compact(F.array(*[F.when(ends[gap], slice_) for gap, slice_ in zip(gaps, made)]))
    return _finish_device(summed.select(*DEVICE_IDS, F.explode(ended).alias("_s")).select(*DEVICE_IDS, "_s.*"))


def _finish_device(totals: DataFrame) -> DataFrame:
    value = F.col("total").cast("double")
    return S.with_slice_parts(totals).select(
        *DEVICE_IDS,
        "slice_gap",
        "slice_start",
        "slice_date",
        "slice_index",
        value.alias("value"),
        F.col("count").cast("double").alias("count"),
        numeric.safe_mean(value, F.col("count")).alias("avg"),
    )


def device_slices(readings: DataFrame, gaps=DEFAULT_GAPS) -> DataFrame:
    """Sum, count and average per device and slice, for one width or several at once."""
    gaps = check_gaps(gaps)
    if len(gaps) > 1:
        return rollup_base(base_slices(readings, base_gap(gaps)), gaps)
    only = base_slices(readings, gaps[0]).withColumn("slice_gap", F.lit(gaps[0]))
    return _finish_device(only)


_SLICE = ["slice_gap", "slice_start", "slice_date", "slice_index"]


def _roll(device: DataFrame, level: str) -> DataFrame:
    # A slice's date and index follow from its start; grouping on them too would only
    # widen the shuffle key.
    summed = device.groupBy(*schemas.slice_keys(level)).agg(numeric.exact_sum(F.col("avg")).alias("avg"))
    return S.with_slice_parts(summed).select(*schemas.ids(level), *_SLICE, "avg")


def household_slices(device: DataFrame) -> DataFrame:
    """Household load: the sum of its devices' averages in the slice."""
    return _roll(device, HOUSEHOLD)


def house_slices(device: DataFrame) -> DataFrame:
    """House load: the sum of its devices' averages in the slice."""
    return _roll(device, HOUSE)


def hierarchy_rollup(device: DataFrame) -> DataFrame:
    """Household and house loads in one pass; ``household_id`` is null on house rows."""
    summed = device.groupingSets(
        [
            [F.col("house_id"), F.col("household_id"), F.col("slice_gap"), F.col("slice_start")],
            [F.col("house_id"), F.col("slice_gap"), F.col("slice_start")],
        ],
        "house_id",
        "household_id",
        "slice_gap",
        "slice_start",
    ).agg(
        F.when(F.grouping("household_id") == 0, HOUSEHOLD).otherwise(HOUSE).alias("level"),
        numeric.exact_sum(F.col("avg")).alias("avg"),
    )
    return S.with_slice_parts(summed).select("level", "house_id", "household_id", *_SLICE, "avg")


def level_slices(readings: DataFrame, level: str, gaps=DEFAULT_GAPS) -> DataFrame:
    device = device_slices(readings, gaps)
    return device if level == DEVICE else _roll(device, level)


def stale_slices(readings: DataFrame, now, gaps=DEFAULT_GAPS, keep: int = 5) -> DataFrame:
    """Slices whose house and household rows have both been idle for ``keep`` gaps.

    ``now`` is a timestamp column or literal; idle time counts from the last reading.
    """
    gaps = check_gaps(gaps)
    touched = (
        load_only(readings)
        .groupBy(
            "house_id",
            "household_id",
            S.slice_start(F.col("timestamp"), F.lit(base_gap(gaps))).alias("slice_start"),
        )
        .agg(F.max("timestamp").alias("last"))
        .withColumn("slice_gap", F.explode(F.array(*[F.lit(g) for g in gaps])))
        .withColumn("slice_start", S.slice_start(F.unix_seconds("slice_start"), F.col("slice_gap")))
    )
    idle_since = F.unix_seconds(now) - F.col("slice_gap") * 60 * keep

    def idle(level):
        last = touched.groupBy(*schemas.slice_keys(level)).agg(F.max("last").alias("last"))
        return last.where(F.col("last") < idle_since).select("slice_gap", "slice_start").distinct()

    both = idle(HOUSE).join(idle(HOUSEHOLD), ["slice_gap", "slice_start"], "left_semi")
    return S.with_slice_parts(both)
