"""The streaming job: readings in, every table kept up to date batch by batch.

The stream itself holds one stateful step, sums per device and base slice, each device on
its own clock (``device_clock``), so a batch carries exactly the base slices that changed.
The rest of a flush is batch work on stored tables, in this order: base slices, device
slices, household and house slices, alerts, forecasts, baselines. Every step replaces keyed
rows computed from stored ones, so a batch that runs twice leaves what it left the first time.
A device that lags behind the others may change days whose baselines are folded already;
those series are folded anew.
"""

from __future__ import annotations

import time
from concurrent.futures import ThreadPoolExecutor
from datetime import timedelta

from pyspark.sql import DataFrame, functions as F

from wattfold import schemas
from wattfold.config import DEVICE, HOUSE, HOUSEHOLD, LEVELS, EngineConfig, block_gap
from wattfold.functions import slices as S
from wattfold.operators import aggregate
from wattfold.operators.alerts import alert_topics, alerts
from wattfold.operators.baseline import baselines, merge_baselines
from wattfold.operators.forecast import AHEAD, forecast_v0
from wattfold.operators.ingest import batch_metrics
from wattfold.sinks.tables import TableStore
from wattfold.streaming.device_clock import device_sums

_DEVICE_IDS = schemas.ids(DEVICE)


def _together(steps) -> list:
    """Run independent steps at once, so that small jobs do not wait for one another."""
    steps = list(steps)
    with ThreadPoolExecutor(max_workers=max(len(steps), 1)) as pool:
        return [f.result() for f in [pool.submit(step) for step in steps]]


class Flush:
    """One micro-batch of changed base slices applied to the stored tables."""

    def __init__(
        self,
        store: TableStore,
        config: EngineConfig = EngineConfig(),
        publish=None,
        with_alerts: bool = True,
        with_forecasts: bool = True,
    ):
        self.store = store
        self.config = config
        self.publish = publish  # called with the (topic, value) rows of the batch's alerts
        self.with_alerts = with_alerts
        self.with_forecasts = with_forecasts
        self._newest = None  # last slice date stored, looked up once

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        started = time.monotonic()
        store = self.store
        batch = batch.withColumn("slice_date", S.slice_date(F.col("slice_start")))
        # The batch is computed once, into a spool file every later step reads.
        batch = store.spool(batch)
        self._late = batch.where("late > 0") if "late" in batch.columns else None
        changed = batch.where("late = 0").drop("late") if "late" in batch.columns else batch
        dates = sorted(r[0] for r in changed.select("slice_date").distinct().collect())
        if not dates:
            return
        store.upsert("device_base", changed)
        known = self._newest or store.newest_date("device_base")
        self._newest = max(known, dates[-1])
        store.upsert("device_data", self._device(changed, dates))
        # Every step below asks which slices changed.
        touched = dict(zip(LEVELS, _together(
            lambda level=level: store.spool(self._touched(changed, level), f"touched-{level}") for level in LEVELS
        )))
        _together(
            lambda level=level: store.upsert(f"{level}_data", self._sums(touched[level], level, dates))
            for level in (HOUSEHOLD, HOUSE)
        )

        # The levels' alerts and forecasts write a table each and read none of the others'.
        steps = []
        if self.with_alerts:
            steps += [lambda level=level: self._alert(level, touched[level]) for level in LEVELS]
        if self.with_forecasts:
            steps += [lambda level=level: self._forecast(level, touched[level], dates) for level in LEVELS]
        done = _together(steps)
        raised = dict(zip(LEVELS, done)) if self.with_alerts else {}
        if self.with_alerts:
            self._advance(changed, touched)
        self._record(touched, raised, batch_id, dates[-1], time.monotonic() - started)

    def _on(self, dates, name: str) -> DataFrame:
        return self.store.read(name, dates[0], dates[-1]).where(F.col("slice_date").isin(dates))

    # Slices of every gap that contain a changed base slice.
    def _touched(self, changed: DataFrame, level: str) -> DataFrame:
        gaps = F.array(*[F.lit(g) for g in self.config.gaps])
        return (
            changed.select(*schemas.ids(level), "slice_start")
            .distinct()
            .withColumn("slice_gap", F.explode(gaps))
            .withColumn("slice_start", S.slice_start(F.unix_seconds("slice_start"), F.col("slice_gap")))
            .select(*schemas.slice_keys(level))
            .distinct()
        )

    def _device(self, changed: DataFrame, dates) -> DataFrame:
        block = S.slice_start(F.unix_seconds("slice_start"), F.lit(block_gap(self.config.gaps)))
        blocks = changed.select(*_DEVICE_IDS, block.alias("_block")).distinct()
        stored = self._on(dates, "device_base").withColumn("_block", block)
        mine = stored.join(blocks, [*_DEVICE_IDS, "_block"], "left_semi")
        # The blocks' other slices come out as they are stored, which costs less than to sort them out.
        return aggregate.rollup_base(mine.select(*_DEVICE_IDS, "slice_start", "total", "count"), self.config.gaps)

    def _sums(self, touched: DataFrame, level: str, dates) -> DataFrame:
        device = self._on(dates, "device_data")
        mine = device.join(touched, schemas.slice_keys(level), "left_semi")
        roll = aggregate.household_slices if level == HOUSEHOLD else aggregate.house_slices
        return roll(mine)

    def _horizon(self, level: str):
        """First date not yet folded into the level's stored baselines."""
        return self.store.read(f"{level}_prop").agg(F.max("through")).first()[0]

    def _alert(self, level: str, touched: DataFrame) -> DataFrame:
        """Redo the alerts of the touched series since the horizon, and store them."""
        through = self._horizon(level)
        keys = schemas.series_keys(level)
        series = touched.select(*keys, S.slice_date(F.col("slice_start")).alias("_date"))
        series = series.groupBy(*keys).agg(F.min("_date").alias("_date"))
        if through is not None:
            lagging = series.where(F.col("_date") < F.lit(through))
            first = lagging.agg(F.min("_date")).first()[0]
            if first is not None:
                self._redo(level, lagging.select(*keys), first, through)
                series = series.where(F.col("_date") >= F.lit(through))
        series = series.select(*keys)
        start = self.store.read(f"{level}_prop")
        rows = self.store.read(f"{level}_data", through, self._newest)
        mine = rows.join(series, keys, "left_semi")
        found = alerts(mine, level, self.config.alerts[level], start=start)
        self.store.replace(f"{level}_notification", found, through, self._newest, owners=series)
        current = self.store.read(f"{level}_notification", through, self._newest)
        mine_now = current.join(touched, schemas.slice_keys(level), "left_semi")
        if self.publish and self.config.publish_alerts:
            self.publish(alert_topics(mine_now, level, self.config.topic_prefix))
        return mine_now

    def _redo(self, level: str, series: DataFrame, first, through) -> None:
        """Alerts from ``first`` on, and stored baselines, of series that changed before the horizon."""
        keys = schemas.series_keys(level)
        before = self.store.read(f"{level}_data", None, first - timedelta(days=1)).join(series, keys, "left_semi")
        since = self.store.read(f"{level}_data", first, self._newest).join(series, keys, "left_semi")
        found = alerts(since, level, self.config.alerts[level], start=baselines(before, level))
        self.store.replace(f"{level}_notification", found, first, self._newest, owners=series)
        folded = before.unionByName(since.where(F.col("slice_date") < F.lit(through)))
        self.store.upsert(f"{level}_prop", baselines(folded, level).withColumn("through", F.lit(through)))

    def _forecast(self, level: str, touched: DataFrame, dates) -> None:
        """Forecast from the touched slices, and anew from later ones that look back on them.

        Only the target times of day of these are read.
        """
        keys = schemas.slice_keys(level)
        stored = self.store.read(f"{level}_data")
        if self.store.newest_date(f"{level}_data_forecast") is None:
            # Every slice is a source: each series is walked once, instead of joined with its own past.
            self.store.upsert(f"{level}_data_forecast", forecast_v0(stored, level))
            return
        if dates[0] < self._newest:
            span = F.col("slice_gap") * 60
            looked_at = touched.select(
                *schemas.series_keys(level),
                F.pmod(F.unix_seconds("slice_start") - AHEAD * span, F.lit(S.DAY_SECONDS)).alias("_second"),
                F.col("slice_start").alias("_changed"),
            )
            first = looked_at.groupBy(*schemas.series_keys(level), "_second").agg(F.min("_changed").alias("_changed"))
            later = self.store.read(f"{level}_data", dates[0], self._newest)
            later = later.withColumn("_second", F.pmod(F.unix_seconds("slice_start"), F.lit(S.DAY_SECONDS)))
            later = later.join(first, [*schemas.series_keys(level), "_second"])
            later = later.where(F.col("slice_start") > F.col("_changed")).select(*keys)
            touched = self.store.spool(touched.union(later).distinct(), f"forecast-{level}")
            dates = sorted(r[0] for r in touched.select(S.slice_date(F.col("slice_start"))).distinct().collect())
        sources = self._on(dates, f"{level}_data").join(touched, keys, "left_semi")
        target = S.shift_slice(F.col("slice_start"), F.col("slice_gap"), AHEAD)
        wanted = touched.select(
            *schemas.series_keys(level), S.slice_index(target, F.col("slice_gap")).alias("slice_index")
        ).distinct()
        # One index list per gap, at most a day's slices each, reaches the parquet reader.
        slots = wanted.groupBy("slice_gap").agg(F.collect_set("slice_index").alias("at")).collect()
        at_slots = F.lit(False)
        for row in slots:
            at_slots = at_slots | ((F.col("slice_gap") == row["slice_gap"]) & F.col("slice_index").isin(row["at"]))
        history = stored.where(at_slots).join(wanted, [*schemas.series_keys(level), "slice_index"], "left_semi")
        said = forecast_v0(history, level, sources=sources)
        self.store.upsert(f"{level}_data_forecast", said)

    def _advance(self, changed: DataFrame, touched) -> None:
        """Fold whole days behind the clocks of most devices into the stored baselines.

        The day follows the middle one of the devices in the batch, so that no single clock rules.
        """
        clocks = changed.groupBy(*_DEVICE_IDS).agg(F.unix_seconds(F.max("slice_start")).alias("t"))
        middle = clocks.agg(F.percentile("t", F.lit(0.5)).cast("bigint").alias("t"))
        last = middle.select(
            S.slice_date(F.timestamp_seconds(F.col("t") - self.config.watermark_minutes * 60))
        ).first()[0]
        _together(lambda level=level: self._fold(level, last) for level in LEVELS)

    def _fold(self, level: str, last) -> None:
        through = self._horizon(level)
        if through is not None and last <= through:
            return
        # Up to the first fold there is no lower bound; from then on it is a day or so.
        closed = self.store.read(f"{level}_data", through, last - timedelta(days=1))
        fresh = baselines(closed, level)
        merged = merge_baselines(self.store.read(f"{level}_prop"), fresh, level)
        self.store.upsert(f"{level}_prop", merged.withColumn("through", F.lit(last)))

    def _record(self, touched, raised, batch_id: int, newest, seconds: float) -> None:
        counts = batch_metrics(touched, raised)
        late = self._late.agg(F.coalesce(F.sum("late"), F.lit(0))).first()[0] if self._late is not None else 0
        self.store.upsert(
            "flush_metrics",
            counts.withColumns(
                {
                    "readings_late": F.lit(late).cast("bigint"),
                    "seconds": F.lit(seconds),
                    "batch_id": F.lit(batch_id).cast("bigint"),
                    "slice_date": F.lit(newest),
                }
            ),
        )


def start_flush(
    readings: DataFrame,
    store: TableStore,
    checkpoint: str,
    config: EngineConfig = EngineConfig(),
    once: bool = False,
    **options,
):
    """Start the job; with ``once`` it takes what is there and stops.

    ``config.clean_tables`` empties the tables first; give a new checkpoint with it.
    """
    store.init_tables(purge=config.clean_tables)
    writer = (
        device_sums(readings, config)
        .writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(Flush(store, config, **options))
    )
    trigger = {"availableNow": True} if once else {"processingTime": f"{config.flush_seconds} seconds"}
    return writer.trigger(**trigger).start()


def run_flush(*args, **kwargs):
    """Take what is there, wait until it is processed, and return the query."""
    query = start_flush(*args, **kwargs, once=True)
    query.awaitTermination()
    return query


def progress_rows(query) -> list[dict]:
    """Input, state and late-row counts of the query's recent batches."""
    out = []
    for p in query.recentProgress:
        state = p.stateOperators
        out.append(
            {
                "batch_id": p.batchId,
                "input_rows": p.numInputRows,
                "rows_per_second": p.processedRowsPerSecond,
                "state_rows": sum(s.numRowsTotal for s in state),
                "dropped_late": p.observedMetrics["slices"]["late"] if "slices" in p.observedMetrics else 0,
            }
        )
    return out
