"""Streaming sums per device and base slice, each device on its own clock.

A watermark over the whole stream follows the fastest clock: one device a year ahead, and
every reading of the others is late. Here each device carries its own state. How late
a reading may be is measured against that device's newest reading alone, and its slices are
dropped from the state once its own time has passed them. A timer closes devices that fell
silent.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from decimal import Context, Decimal

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from wattfold import schemas
from wattfold.config import DEVICE, EngineConfig, base_gap
from wattfold.functions import numeric, slices as S
from wattfold.sources.readings import load_only

# Spark asks the processor for its states in a process of its own, which need not find this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

_IDS = schemas.ids(DEVICE)
_SCALE = numeric.SUM_SCALE
_UNIT = 10**_SCALE  # what a sum's fraction counts
_ROWS = 8192  # fractions that add up without leaving an unsigned 64-bit number
_WIDE = Context(prec=60)

CHANGED = T.StructType(
    [
        *[T.StructField(c, T.IntegerType()) for c in _IDS],
        T.StructField("slice_start", T.TimestampType()),
        T.StructField("total", T.DecimalType(38, 15)),
        T.StructField("count", T.LongType()),
        T.StructField("late", T.LongType()),
    ]
)


def sums_of(start: np.ndarray, whole: np.ndarray, part: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """Slice start, exact sum in units of the last decimal place, and number of rows."""
    for a in range(0, len(start), _ROWS):
        order = np.argsort(start[a : a + _ROWS], kind="stable") + a
        at, first, count = np.unique(start[order], return_index=True, return_counts=True)
        wholes = np.add.reduceat(whole[order], first)
        parts = np.add.reduceat(part[order].astype(np.uint64), first)
        for s, w, p, n in zip(at, wholes, parts, count):
            yield int(s), int(w) * _UNIT + int(p), int(n)


class DeviceClock(StatefulProcessor):
    """State of a device: its clock, and the sums of the slices still open.

    ``clock`` holds the newest reading's time, the time up to which slices are closed, the
    oldest open slice, when (by arrival) it was last heard of, and whether a timer is set.
    """

    def __init__(self, gap_minutes: int, late_minutes: int, idle_minutes: int):
        self.gap, self.late, self.idle_ms = gap_minutes * 60, late_minutes * 60, idle_minutes * 60_000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.clock = handle.getValueState("clock", "newest long, closed long, oldest long, heard long, timed boolean")
        self.open = handle.getMapState("open", "start long", "units string, rows long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        newest, closed, oldest, heard, timed = self.clock.get() or (None, None, None, 0, False)
        sums: dict[int, list[int]] = {}
        late: dict[int, int] = {}
        latest = newest
        for batch in rows:
            top = int(batch["timestamp"].max())
            latest = top if latest is None else max(latest, top)
            heard = max(heard, int(batch["heard"].max().timestamp() * 1000))
            for start, units, n in sums_of(*(batch[c].to_numpy() for c in ("start", "whole", "part"))):
                if closed is not None and start + self.gap <= closed:
                    late[start] = late.get(start, 0) + n
                    continue
                have = sums.setdefault(start, [0, 0])
                have[0] += units
                have[1] += n
        # What this delivery moves on counts as late from the next one on.
        until = latest - self.late if closed is None else max(closed, latest - self.late)
        for start, have in sums.items():
            if oldest is not None and oldest <= start <= newest:
                stored = self.open.getValue((start,))
                if stored is not None:
                    have[0] += int(stored[0])
                    have[1] += int(stored[1])
        # Each access to the state is a message to the JVM: slices that end by then never get there.
        kept = [start for start in sums if start + self.gap > until]
        for start in kept:
            self.open.updateValue((start,), (str(sums[start][0]), sums[start][1]))
        closed = until
        if oldest is not None and oldest + self.gap <= closed:
            oldest = self._evict(closed)
        elif kept:
            oldest = min(kept) if oldest is None else min(oldest, *kept)
        if not timed:
            self.handle.registerTimer(heard + self.idle_ms)
        self.clock.update((latest, closed, oldest, heard, True))
        yield _frame(key, sums, late)

    def _evict(self, closed: int) -> int | None:
        """Forget the slices that have ended by ``closed``; the oldest that stays."""
        starts = [int(k[0]) for k in self.open.keys()]
        gone = [s for s in starts if s + self.gap <= closed]
        for start in gone:
            self.open.removeKey((start,))
        return min((s for s in starts if s + self.gap > closed), default=None)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        newest, closed, oldest, heard, _ = self.clock.get()
        if timerValues.getCurrentWatermarkInMs() - heard >= self.idle_ms:
            # Silent for long: nothing of it stays open, but its clock stays, so that
            # a straggler cannot start a stored slice anew.
            self.open.clear()
            self.clock.update((newest, max(closed, newest + self.gap), None, heard, False))
        else:
            self.handle.registerTimer(heard + self.idle_ms)
        return iter(())

    def close(self) -> None:
        pass


def _frame(key, sums: dict[int, list[int]], late: dict[int, int]) -> pd.DataFrame:
    n = len(sums) + len(late)
    start = np.fromiter((*sums, *late), "int64", n) * 1_000_000
    totals = [Decimal(units).scaleb(-_SCALE, _WIDE) for units, _ in sums.values()]
    counts = [*(rows for _, rows in sums.values()), *[None] * len(late)]
    return pd.DataFrame(
        {
            **{name: np.full(n, key[i]) for i, name in enumerate(_IDS)},
            "slice_start": pd.DatetimeIndex(start.view("datetime64[us]")).tz_localize("UTC"),
            "total": np.array([*totals, *[None] * len(late)], dtype=object),
            "count": pd.array(counts, dtype="Int64"),
            "late": np.array([0] * len(sums) + list(late.values()), dtype="int64"),
        }
    )


def device_sums(readings: DataFrame, config: EngineConfig) -> DataFrame:
    """The base slices each delivery changed: ids, ``slice_start``, ``total``, ``count``.

    Rows with ``late`` above 0 tell how many readings of a closed slice were left out instead;
    their sums are null. The counts are observed as ``slices`` as well, for listeners.
    """
    gap = base_gap(config.gaps)
    readings.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    value = numeric.exact(F.col("value"))
    units = (value - F.floor(value)) * F.lit(_UNIT)
    placed = load_only(readings).select(
        *_IDS[:2],
        F.col("plug_id").alias("device_id"),
        F.col("timestamp"),
        F.unix_seconds(S.slice_start(F.col("timestamp"), F.lit(gap))).alias("start"),
        F.floor(value).cast("bigint").alias("whole"),
        units.cast("bigint").alias("part"),
    )
    # The watermark lies on the time of arrival: no reading is late by it, it only drives the timers.
    placed = placed.withColumn("heard", F.current_timestamp()).withWatermark("heard", "1 minute")
    processor = DeviceClock(gap, config.watermark_minutes, config.idle_minutes)
    changed = placed.groupBy(*_IDS).transformWithStateInPandas(processor, CHANGED, "Update", "EventTime")
    return changed.observe(
        "slices",
        F.count_if(F.col("late") == 0).alias("changed"),
        F.coalesce(F.sum("late"), F.lit(0)).alias("late"),
    )
