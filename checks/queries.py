"""Every operator as a query over the test tables, shaped so that results can be compared.

Timestamps come back as date text plus slice index, and doubles rounded; the rounding
nudges decimal ties upward so that both engines settle them alike.
"""

from __future__ import annotations

import datetime
from functools import partial

from pyspark.sql import DataFrame, SparkSession, functions as F

from wattfold import schemas
from wattfold.config import DEFAULT_GAPS, DEVICE, HOUSE, HOUSEHOLD, LEVELS, AlertConfig, EngineConfig
from wattfold.functions import slices as S
from wattfold.operators import aggregate, alerts as A, baseline, forecast, history, ingest, stats, topology
from wattfold.plans import reads, records
from wattfold.plans.scoring import score_stored
from wattfold.session import scratch_dir, utc
from wattfold.sinks.tables import TableStore, load_baselines
from wattfold.sources import readings as R
from wattfold.sources.feed import publish_segments, stream_feed
from wattfold.streaming.device_clock import device_sums
from wattfold.streaming.flush import run_flush

ALL_CHECKS = AlertConfig(pct=20, check_min=True, check_avg=True, check_max=True)
STORED_GAPS = (60, 120)
STREAM_CONFIG = EngineConfig(gaps=STORED_GAPS, alerts={level: ALL_CHECKS for level in LEVELS})
WHOLE_CONFIG = EngineConfig(gaps=DEFAULT_GAPS, alerts={level: ALL_CHECKS for level in LEVELS})
NOW = "2024-01-31 00:00:00"
NUDGE = 1e-9  # lifts decimal ties in printed numbers, here and in the SQL alike


def rounded(col, places: int = 6):
    """Half up at ``places``; a thousandth of the last place lifts ties over binary noise."""
    scale = F.lit(10.0**places)
    return (F.floor(F.col(f"`{col}`") * scale + F.lit(0.501)).cast("double") / scale).alias(col)


def shaped(df: DataFrame, *columns: str, doubles=(), places: int = 6) -> DataFrame:
    out = []
    for c in columns:
        if c in doubles:
            out.append(rounded(c, places))
        elif c == "slice_date":
            out.append(F.date_format(c, "yyyy-MM-dd").alias(c))
        else:
            out.append(F.col(c))
    return df.select(*out)


def load(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.readings_from_events(R.read_events(spark, sf_dir))


def level_slices(spark, sf_dir, level, gaps=DEFAULT_GAPS) -> DataFrame:
    return aggregate.level_slices(load(spark, sf_dir), level, gaps)


def slice_columns(level):
    return [*schemas.ids(level), "slice_gap", "slice_date", "slice_index"]


# -- sources ----------------------------------------------------------------------------

READING = schemas.READING.names


def messages(spark, sf_dir) -> DataFrame:
    """Events as CSV messages; those of property 0 carry a timestamp that does not parse."""
    rows = load(spark, sf_dir)
    broken = F.when(F.col("property") == 0, "notatime").otherwise(F.col("timestamp").cast("string"))
    return R.encode_readings(rows.withColumn("timestamp", broken))


def decode_readings(spark, sf_dir):
    return R.decode_readings(messages(spark, sf_dir)).select(*READING)


def decode_quarantine(spark, sf_dir):
    return R.quarantine(messages(spark, sf_dir)).select(F.col("value").alias("message"))


def load_only(spark, sf_dir):
    return R.load_only(load(spark, sf_dir)).select(*READING)


def by_topic(spark, sf_dir):
    events = R.read_events(spark, sf_dir)
    is_error = F.col("event_type").eqNullSafe("error")
    return R.union_topics(
        {
            "iot-errors": R.readings_from_events(events.where(is_error)),
            "iot-data": R.readings_from_events(events.where(~is_error)),
        }
    )


def union_topics(spark, sf_dir):
    return by_topic(spark, sf_dir).select("topic", *READING)


def ingest_stream(spark, sf_dir):
    """Messages arriving as text files, decoded on a stream into a parquet table."""
    folder = scratch_dir(utc(spark), "ingest")
    messages(spark, sf_dir).write.text(f"{folder}/feed")
    decoded = R.decode_readings(R.stream_messages(spark, f"{folder}/feed"))
    query = (
        decoded.writeStream.format("parquet")
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(availableNow=True)
        .start(f"{folder}/table")
    )
    query.awaitTermination()
    return spark.read.schema(schemas.READING).parquet(f"{folder}/table").select(*READING)


def drop_repeats_stream(spark, sf_dir):
    """Every message comes twice, in one delivery; one copy an id stays."""
    folder = scratch_dir(utc(spark), "repeats")
    for _ in range(2):
        messages(spark, sf_dir).write.mode("append").text(f"{folder}/feed")
    decoded = R.decode_readings(R.stream_messages(spark, f"{folder}/feed"))
    query = (
        R.drop_repeats(decoded, EngineConfig().watermark_minutes).select(*READING)
        .writeStream.format("parquet")
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(availableNow=True)
        .start(f"{folder}/table")
    )
    query.awaitTermination()
    return spark.read.schema(schemas.READING).parquet(f"{folder}/table").select(*READING)


def ingest_feed_stream(spark, sf_dir):
    """Messages of two topics through the feed source; the job stops in mid-feed and starts again."""
    folder = scratch_dir(utc(spark), "feed")
    rows = by_topic(spark, sf_dir)
    parts = (rows.where(F.col("id") % 2 == 0), rows.where(F.col("id") % 2 == 1))
    for part in parts:
        encoded = part.select("topic", F.concat_ws(",", *READING).alias("value"))
        landing = scratch_dir(spark, "landing")
        encoded.write.partitionBy("topic").text(f"{landing}/out")
        publish_segments(spark, f"{landing}/out", f"{folder}/feed")
        decoded = R.decode_readings(stream_feed(spark, f"{folder}/feed")).select("topic", *READING)
        query = (
            decoded.writeStream.format("parquet")
            .option("checkpointLocation", f"{folder}/checkpoint")
            .trigger(availableNow=True)
            .start(f"{folder}/table")
        )
        query.awaitTermination()
    return spark.read.schema(decoded.schema).parquet(f"{folder}/table")


def ingest_rate(spark, sf_dir):
    rates = ingest.ingest_rate(by_topic(spark, sf_dir))
    return rates.select(
        "topic",
        F.unix_seconds("interval_start").alias("interval_start"),
        "total",
        "load",
        rounded("total_speed"),
        rounded("load_speed"),
    )


def ingest_rollup(spark, sf_dir):
    """Every fifth message is unusable; those of the last day are still queued."""
    rows = by_topic(spark, sf_dir)
    last = rows.agg(F.max("timestamp")).scalar()
    stamp = F.when(F.col("id") % 5 == 0, "notatime").otherwise(F.col("timestamp").cast("string"))
    encoded = rows.select(
        "topic",
        (F.col("timestamp") > last - 86400).alias("waits"),
        F.concat_ws(",", *[stamp if c == "timestamp" else F.col(c).cast("string") for c in READING]).alias("value"),
    )
    taken = encoded.where("not waits").select("topic", "value")
    queued = encoded.groupBy("topic").agg(F.count_if("waits").alias("queue"))
    usable = R.decode_readings(taken)
    newest = usable.agg(F.timestamp_seconds(F.max("timestamp"))).scalar()
    rolled = ingest.ingest_rollup(ingest.ingest_snapshots(usable, ingest.ingest_counts(taken), newest, queued))
    doubles = ("total_speed", "load_speed")
    return shaped(rolled, *rolled.columns, doubles=doubles)


# -- slices -----------------------------------------------------------------------------


def assign_slice(spark, sf_dir):
    return shaped(
        aggregate.assign_slice(load(spark, sf_dir), 15), "id", "slice_gap", "slice_date", "slice_index"
    )


def multi_window(spark, sf_dir):
    return shaped(
        aggregate.multi_window(load(spark, sf_dir)), "id", "slice_gap", "slice_date", "slice_index"
    )


def device_slices(spark, sf_dir):
    doubles = ("value", "count", "avg")
    return shaped(level_slices(spark, sf_dir, DEVICE), *slice_columns(DEVICE), *doubles, doubles=doubles)


def upper_slices(spark, sf_dir, level):
    return shaped(level_slices(spark, sf_dir, level), *slice_columns(level), "avg", doubles=("avg",))


def hierarchy_rollup(spark, sf_dir):
    rolled = aggregate.hierarchy_rollup(level_slices(spark, sf_dir, DEVICE))
    rolled = rolled.withColumn("household_id", F.coalesce("household_id", F.lit(-1)))
    return shaped(rolled, "level", *slice_columns(HOUSEHOLD), "avg", doubles=("avg",))


def stale_slices(spark, sf_dir):
    rows = load(spark, sf_dir)
    newest = R.load_only(rows).agg(F.timestamp_seconds(F.max("timestamp"))).scalar()
    return shaped(aggregate.stale_slices(rows, newest), "slice_gap", "slice_date", "slice_index")


def labelled(spark, sf_dir):
    parts = [F.col(c) for c in ("slice_date", "slice_index", "slice_gap")]
    return level_slices(spark, sf_dir, HOUSE).withColumns(
        {
            "slice_id": S.slice_id(*parts),
            "slice_label": S.slice_label(*parts),
            "date_label": S.date_label(parts[0]),
        }
    )


def slice_labels(spark, sf_dir):
    return labelled(spark, sf_dir).select("house_id", "slice_id", "slice_label", "date_label")


def parse_slice_id(spark, sf_dir):
    ids = labelled(spark, sf_dir).select("house_id", "slice_id")
    parsed = ids.withColumns(S.parse_slice_id(F.col("slice_id")))
    return shaped(parsed, "house_id", "slice_id", "slice_gap", "slice_date", "slice_index")


def next_slice(spark, sf_dir):
    house = level_slices(spark, sf_dir, HOUSE)
    gap = F.col("slice_gap")
    later = S.shift_slice(F.col("slice_start"), gap, 2)
    return house.select(
        "house_id",
        "slice_gap",
        F.date_format("slice_date", "yyyy-MM-dd").alias("slice_date"),
        "slice_index",
        F.date_format(S.slice_date(later), "yyyy-MM-dd").alias("next_date"),
        S.slice_index(later, gap).alias("next_index"),
    )


def entity_keys(spark, sf_dir):
    ids = [F.col(c) for c in schemas.ids(DEVICE)]
    device = level_slices(spark, sf_dir, DEVICE)
    slice_key = S.slice_id(F.col("slice_date"), F.col("slice_index"), F.col("slice_gap"))
    return device.select(
        S.entity_key(*ids).alias("device_key"),
        S.entity_key(*ids[:2]).alias("household_key"),
        S.entity_key(ids[0]).alias("house_key"),
        S.entity_key(*ids, slice_key).alias("device_slice_key"),
    )


# -- baselines and alerts ---------------------------------------------------------------

BASE = ("min", "avg", "max")
PRIOR = ("prior_min", "prior_avg", "prior_max")


def baselines(spark, sf_dir, level):
    totals = baseline.baselines(level_slices(spark, sf_dir, level), level)
    return shaped(totals, *schemas.series_keys(level), *BASE, "count", doubles=BASE)


def load_stored_baselines(spark, sf_dir):
    store = TableStore(spark, scratch_dir(utc(spark), "baselines"))
    house = level_slices(spark, sf_dir, HOUSE)
    store.upsert("house_prop", baseline.baselines(house, HOUSE).withColumn("through", F.lit(None)))
    stored = load_baselines(store, HOUSE)
    return shaped(stored, *schemas.series_keys(HOUSE), *BASE, "count", doubles=BASE)


def attach_baseline(spark, sf_dir):
    house = level_slices(spark, sf_dir, HOUSE)
    first_half = baseline.baselines(house.where(F.dayofmonth("slice_date") <= 15), HOUSE)
    joined = baseline.attach_baseline(house, first_half, HOUSE)
    return shaped(joined, *slice_columns(HOUSE), "avg", *PRIOR, "prior_count", doubles=("avg", *PRIOR))


def running_baseline(spark, sf_dir, level):
    rows = baseline.running_baseline(level_slices(spark, sf_dir, level), level)
    return shaped(rows, *slice_columns(level), "avg", *PRIOR, "prior_count", doubles=("avg", *PRIOR))


ALERT = ("value", "min", "avg", "max")


def raw_alerts(spark, sf_dir, level, gaps=DEFAULT_GAPS):
    return A.alerts(level_slices(spark, sf_dir, level, gaps), level, ALL_CHECKS)


def alerts(spark, sf_dir, level):
    rows = raw_alerts(spark, sf_dir, level)
    return shaped(rows, "type", *slice_columns(level), *ALERT, doubles=ALERT)


def alerts_page(spark, sf_dir, level, **page):
    rows = reads.alerts_page(raw_alerts(spark, sf_dir, level), level, **page)
    return shaped(rows, "type", *slice_columns(level), *ALERT, doubles=ALERT)


def per_level(spark, sf_dir, build, gaps=(60,)):
    frames = []
    for level in LEVELS:
        rows = raw_alerts(spark, sf_dir, level, gaps)
        rows = rows.withColumns({c: rounded(c) for c in ALERT})
        frames.append(build(rows, level))
    return frames[0].unionByName(frames[1]).unionByName(frames[2])


def alert_topics(spark, sf_dir, gaps=(60,)):
    return per_level(spark, sf_dir, lambda rows, level: A.alert_topics(rows, level, "home/"), gaps)


def alert_change(spark, sf_dir, gaps=(60,)):
    def build(rows, level):
        change = rows.withColumns({"level": F.lit(level), "change": A.alert_change(NUDGE)})
        return shaped(change, "level", "type", "house_id", "slice_date", "slice_index", "change")

    return per_level(spark, sf_dir, build, gaps)


def alert_messages(spark, sf_dir, gaps=(60,)):
    now = F.lit(NOW).cast("timestamp")
    return per_level(
        utc(spark), sf_dir, lambda rows, level: A.alert_messages(rows, level, now, NUDGE).select("title", "body"), gaps
    )


def time_ago(spark, sf_dir):
    rows = load(spark, sf_dir)
    age = A.time_ago(F.timestamp_seconds("timestamp"), F.lit(NOW).cast("timestamp"))
    return rows.select("id", age.alias("age"))


def batch_metrics(spark, sf_dir):
    saved = {level: level_slices(spark, sf_dir, level) for level in LEVELS}
    raised = {level: raw_alerts(spark, sf_dir, level) for level in LEVELS}
    return ingest.batch_metrics(saved, raised)


def flagship(spark, sf_dir):
    rows = records.record_breakers(load(spark, sf_dir))
    return shaped(rows, "type", *slice_columns(HOUSE), *ALERT, doubles=ALERT)


# -- forecasts --------------------------------------------------------------------------

SAID = ("avg", "median")


def forecast_level(spark, sf_dir, version, level):
    said = forecast.FORECASTS[version](level_slices(spark, sf_dir, level), level)
    return shaped(said, "version", *slice_columns(level), *SAID, "history", doubles=SAID)


def house_and_forecast(spark, sf_dir, gaps=DEFAULT_GAPS, versions=("v0",)):
    return house_and_forecast_of(level_slices(spark, sf_dir, HOUSE, gaps), versions)


def house_and_forecast_of(house, versions):
    said = [forecast.FORECASTS[v](house, HOUSE) for v in versions]
    both = said[0]
    for more in said[1:]:
        both = both.unionByName(more)
    return house, both


SCORE = ("mean", "variance", "standard_deviation", "mse")


def scored(df):
    return shaped(df, "version", "slice_gap", "count", *SCORE, doubles=SCORE, places=4)


def forecast_score(spark, sf_dir):
    versions = ("v0", "v2", "v3")
    return scored(stats.forecast_score(*house_and_forecast(spark, sf_dir, versions=versions), versions))


def get_forecast_score(spark, sf_dir):
    scores = stats.forecast_score(*house_and_forecast(spark, sf_dir))
    return scored(reads.get_forecast_score(scores, "v0", 60))


def actual_vs_forecast(spark, sf_dir):
    aligned = stats.actual_vs_forecast(*house_and_forecast(spark, sf_dir))
    doubles = ("actual", "forecast")
    return shaped(aligned, *slice_columns(HOUSE), "position", *doubles, doubles=doubles)


def series_stats(spark, sf_dir):
    house = level_slices(spark, sf_dir, HOUSE)
    doubles = ("mean", "variance", "standard_deviation")
    out = stats.series_stats(house, schemas.series_keys(HOUSE))
    return shaped(out, *schemas.series_keys(HOUSE), "count", *doubles, doubles=doubles, places=4)


# -- histories --------------------------------------------------------------------------


def of_latest(spark, sf_dir, find):
    house = level_slices(spark, sf_dir, HOUSE)
    rows = find(house, history.latest_slices(house))
    rows = rows.withColumn("request_start", F.unix_seconds("request_start"))
    more = ["weeks_back"] if "weeks_back" in rows.columns else []
    return shaped(rows, *slice_columns(HOUSE), "request_start", *more, "avg", doubles=("avg",))


def weekly_chains(spark, sf_dir):
    chains = history.weekly_chains(level_slices(spark, sf_dir, HOUSE))
    return shaped(chains, *slice_columns(HOUSE), "chain_week")


# -- reads ------------------------------------------------------------------------------


def slice_tables(spark, sf_dir, gaps):
    device = level_slices(spark, sf_dir, DEVICE, gaps)
    return {
        DEVICE: device,
        HOUSEHOLD: aggregate.household_slices(device),
        HOUSE: aggregate.house_slices(device),
    }


def query_slices(spark, sf_dir, **filters):
    rows = reads.query_slices(slice_tables(spark, sf_dir, DEFAULT_GAPS), **filters)
    level = reads.level_for(filters.get("household_id"), filters.get("device_id"))
    return shaped(rows, *slice_columns(level), "avg", doubles=("avg",))


def query_week(spark, sf_dir):
    rows = reads.query_week(slice_tables(spark, sf_dir, DEFAULT_GAPS), 1, year=2024, month=1, slice_gap=30)
    return shaped(rows, *slice_columns(HOUSE), "avg", doubles=("avg",))


def forecast_tables(spark, sf_dir):
    return {
        level: forecast.forecast_v0(df, level)
        for level, df in slice_tables(spark, sf_dir, DEFAULT_GAPS).items()
    }


def query_forecast(spark, sf_dir):
    rows = reads.query_forecast(forecast_tables(spark, sf_dir), "v0", household_id=1, month=1, slice_gap=60)
    return shaped(rows, *slice_columns(HOUSEHOLD), "avg", doubles=("avg",))


def query_forecast_week(spark, sf_dir):
    rows = reads.query_forecast_week(forecast_tables(spark, sf_dir), 2, year=2024, month=1, slice_gap=120)
    return shaped(rows, *slice_columns(HOUSE), "avg", doubles=("avg",))


def export_wide(spark, sf_dir):
    wide = reads.export_wide(level_slices(spark, sf_dir, HOUSE, (60,)), 60)
    doubles = [c for c in wide.columns if c not in ("house_id", "slice_date", "count")]
    return wide.select(
        "house_id",
        F.date_format("slice_date", "yyyy-MM-dd").alias("slice_date"),
        "count",
        *[rounded(c, 4) for c in doubles],
    )


def meta_gaps(spark, sf_dir):
    return topology.meta_gaps(level_slices(spark, sf_dir, HOUSE))


def meta_dates(spark, sf_dir, level):
    return topology.meta_dates(level_slices(spark, sf_dir, level), level)


def meta_tree(spark, sf_dir):
    tree = topology.meta_tree(level_slices(spark, sf_dir, DEVICE))
    return tree.withColumn("dates", F.to_json("dates"))


# -- stored tables ----------------------------------------------------------------------


def new_store(spark, label):
    return TableStore(spark, scratch_dir(utc(spark), label))


def twice(spark, sf_dir, label, tables, build, gaps=STORED_GAPS):
    """Upsert what the first 20 days give, then what all give, and read the tables back."""
    store = new_store(spark, label)
    rows = load(spark, sf_dir)
    early = rows.where(F.col("timestamp") < F.lit(1705708800))
    for part in (early, rows):
        for name, level in tables:
            store.upsert(name, build(aggregate.level_slices(part, level, gaps), level))
    return store


def upsert_slices(spark, sf_dir, level=HOUSEHOLD, gaps=STORED_GAPS):
    name = f"{level}_data"
    store = twice(spark, sf_dir, "slices", [(name, level)], lambda df, level: df, gaps)
    return shaped(store.read(name), *slice_columns(level), "avg", doubles=("avg",))


def upsert_baselines(spark, sf_dir, level=DEVICE, gaps=STORED_GAPS):
    def build(df, level):
        return baseline.baselines(df, level).withColumn("through", F.lit(None))

    name = f"{level}_prop"
    store = twice(spark, sf_dir, "props", [(name, level)], build, gaps)
    return shaped(store.read(name), *schemas.series_keys(level), *BASE, "count", doubles=BASE)


def upsert_forecasts(spark, sf_dir, level=HOUSE, gaps=STORED_GAPS):
    name = f"{level}_data_forecast"
    store = twice(spark, sf_dir, "forecasts", [(name, level)], forecast.forecast_v0, gaps)
    return shaped(store.read(name), "version", *slice_columns(level), "avg", doubles=("avg",))


def upsert_alerts(spark, sf_dir, level=HOUSE, gaps=STORED_GAPS):
    name = f"{level}_notification"
    store = twice(spark, sf_dir, "alerts", [(name, level)], partial(A.alerts, config=ALL_CHECKS), gaps)
    return shaped(store.read(name), "type", *slice_columns(level), *ALERT, doubles=ALERT)


def upsert_scores(spark, sf_dir, gaps=STORED_GAPS):
    def build(df, level):
        return stats.forecast_score(df, forecast.forecast_v0(df, level))

    store = twice(spark, sf_dir, "scores", [("forecast_meta_data", HOUSE)], build, gaps)
    return scored(store.read("forecast_meta_data"))


def score_job(spark, sf_dir):
    """Tables filled in two rounds, the scores brought up to date after each from the days it changed."""
    store = new_store(spark, "score-job")
    rows = load(spark, sf_dir)
    versions, cut = ("v0", "v2", "v3"), datetime.date(2024, 1, 20)
    for part, first in ((rows.where(F.col("timestamp") < F.lit(1705708800)), None), (rows, cut)):
        house, said = house_and_forecast_of(aggregate.level_slices(part, HOUSE), versions)
        since = F.lit(True) if first is None else F.col("slice_date") >= F.lit(first)
        store.upsert("house_data", house.where(since))
        store.upsert("house_data_forecast", said.where(since))
        score_stored(store, versions, first)
    return scored(store.read("forecast_meta_data"))


# -- streams ----------------------------------------------------------------------------


def streamed(spark, sf_dir, label, config=STREAM_CONFIG, **options):
    store = new_store(spark, label)
    # The glob lets the source be a single file as well as a folder of files.
    feed = R.readings_from_events(R.stream_events(spark, f"{sf_dir}/events.parquet*"))
    run_flush(feed, store, f"{store.root}/_checkpoint", config, **options)
    return store


def device_slices_stream(spark, sf_dir, config=STREAM_CONFIG):
    store = streamed(spark, sf_dir, "stream", config, with_alerts=False, with_forecasts=False)
    doubles = ("value", "count", "avg")
    return shaped(store.read("device_data"), *slice_columns(DEVICE), *doubles, doubles=doubles)


def alerts_stream(spark, sf_dir, level=HOUSE, config=STREAM_CONFIG):
    store = streamed(spark, sf_dir, "stream", config, with_forecasts=False)
    stored = store.read(f"{level}_notification")
    return shaped(stored, "type", *slice_columns(level), *ALERT, doubles=ALERT)


def flush_stream(spark, sf_dir, level=HOUSEHOLD, config=STREAM_CONFIG):
    store = streamed(spark, sf_dir, "stream", config)
    stored = store.read(f"{level}_data_forecast")
    return shaped(stored, "version", *slice_columns(level), "avg", doubles=("avg",))


def late_data_stream(spark, sf_dir):
    """Two kinds of events arrive first, with one stamped 40 years ahead; the rest come when many are late.

    How late is up to each device's own clock, so the wrong one costs that device its readings, and no other.
    """
    store = new_store(spark, "late")
    events = R.read_events(spark, sf_dir)
    first = F.coalesce(F.col("event_type").isin("view", "click"), F.lit(False))
    early = events.where(first)
    wrong = early.orderBy("event_id").limit(1).withColumn("ts", F.col("ts") + F.expr("INTERVAL 40 YEARS"))
    feed = f"{store.root}/_feed"
    for part in (early.unionByName(wrong), events.where(~first)):
        part.write.mode("append").parquet(feed)
        changed = device_sums(R.readings_from_events(R.stream_events(spark, feed), arrival=False), EngineConfig())

        def keep(batch, _):
            rows = batch.where("late = 0").withColumn("slice_date", S.slice_date(F.col("slice_start")))
            store.upsert("device_base", rows)

        query = (
            changed.writeStream.outputMode("update")
            .option("checkpointLocation", f"{store.root}/_checkpoint")
            .foreachBatch(keep)
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
    return store.read("device_base").select(
        *schemas.ids(DEVICE),
        F.unix_seconds("slice_start").alias("slice_start"),
        rounded("total"),
        "count",
    )


def build() -> dict:
    q = {
        "decode_readings": decode_readings,
        "decode_quarantine": decode_quarantine,
        "load_only": load_only,
        "union_topics": union_topics,
        "ingest_stream": ingest_stream,
        "ingest_feed_stream": ingest_feed_stream,
        "drop_repeats_stream": drop_repeats_stream,
        "ingest_rate": ingest_rate,
        "ingest_rollup": ingest_rollup,
        "assign_slice": assign_slice,
        "multi_window": multi_window,
        "slice_labels": slice_labels,
        "parse_slice_id": parse_slice_id,
        "next_slice": next_slice,
        "entity_keys": entity_keys,
        "device_slices": device_slices,
        "household_slices": partial(upper_slices, level=HOUSEHOLD),
        "house_slices": partial(upper_slices, level=HOUSE),
        "hierarchy_rollup": hierarchy_rollup,
        "stale_slices": stale_slices,
        "load_baselines": load_stored_baselines,
        "attach_baseline": attach_baseline,
        "record_breakers": flagship,
        "alert_topics": alert_topics,
        "alert_change": alert_change,
        "alert_messages": alert_messages,
        "time_ago": time_ago,
        "batch_metrics": batch_metrics,
        "forecast_score": forecast_score,
        "get_forecast_score": get_forecast_score,
        "actual_vs_forecast": actual_vs_forecast,
        "series_stats": series_stats,
        "history_same_day": partial(of_latest, find=history.history_same_day),
        "history_all": partial(of_latest, find=history.history_all),
        "history_weekly": partial(of_latest, find=history.history_weekly),
        "history_same_index": partial(of_latest, find=history.history_same_index),
        "weekly_chains": weekly_chains,
        "query_slices": partial(query_slices, year=2024, month=1, slice_gap=60),
        "query_slices_household": partial(query_slices, house_id=2, household_id=1, device_id="*"),
        "query_slices_device": partial(query_slices, house_id=0, household_id=0, device_id=0, slice_gap=20),
        "query_week": query_week,
        "query_forecast": query_forecast,
        "query_forecast_week": query_forecast_week,
        "export_wide": export_wide,
        "meta_gaps": meta_gaps,
        "meta_tree": meta_tree,
        "upsert_slices": upsert_slices,
        "upsert_baselines": upsert_baselines,
        "upsert_forecasts": upsert_forecasts,
        "upsert_alerts": upsert_alerts,
        "upsert_scores": upsert_scores,
        "score_job": score_job,
        "device_slices_stream": device_slices_stream,
        "alerts_stream": alerts_stream,
        "flush_stream": flush_stream,
        "late_data_stream": late_data_stream,
    }
    pages = {DEVICE: {}, HOUSEHOLD: {"offset": 10, "limit": 20}, HOUSE: {"house_id": 2}}
    for level in LEVELS:
        q[f"baselines_{level}"] = partial(baselines, level=level)
        q[f"running_baseline_{level}"] = partial(running_baseline, level=level)
        q[f"alerts_{level}"] = partial(alerts, level=level)
        q[f"alerts_page_{level}"] = partial(alerts_page, level=level, **pages[level])
        q[f"forecast_v0_{level}"] = partial(forecast_level, version="v0", level=level)
        q[f"meta_{level}_dates"] = partial(meta_dates, level=level)
        for upsert in (upsert_slices, upsert_baselines, upsert_forecasts, upsert_alerts):
            q[f"{upsert.__name__}_{level}"] = partial(upsert, level=level, gaps=DEFAULT_GAPS)
        q[f"alerts_stream_{level}"] = partial(alerts_stream, level=level, config=WHOLE_CONFIG)
        q[f"flush_stream_{level}"] = partial(flush_stream, level=level, config=WHOLE_CONFIG)
    for every in (alert_topics, alert_change, alert_messages, upsert_scores):
        q[f"{every.__name__}_all_gaps"] = partial(every, gaps=DEFAULT_GAPS)
    q["device_slices_stream_all_gaps"] = partial(device_slices_stream, config=WHOLE_CONFIG)
    for version in ("v1", "v2", "v3"):
        q[f"forecast_{version}_house"] = partial(forecast_level, version=version, level=HOUSE)
    return q
