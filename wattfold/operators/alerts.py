"""Alerts: slices that stand out against the baseline before them, their routing and text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from wattfold import schemas
from wattfold.config import DEVICE, HOUSE, HOUSEHOLD, AlertConfig
from wattfold.functions import slices as S
from wattfold.operators.baseline import running_baseline

UNDER_MIN, OVER_AVG, OVER_MAX = -1, 0, 1


def _rule(switch: bool, kind: int, base: Column, excess: Column, pct: int) -> Column:
    hit = F.lit(switch) & (base != 0) & (excess >= base * pct / 100)
    return F.when(hit, F.lit(kind))


def alerts_from_baseline(slices: DataFrame, level: str, config: AlertConfig) -> DataFrame:
    """One row per rule a slice breaks; the slices carry ``prior_*`` columns."""
    v = F.col("avg")
    low, mid, top = F.col("prior_min"), F.col("prior_avg"), F.col("prior_max")
    kinds = F.array(
        _rule(config.check_max, OVER_MAX, top, v - top, config.pct),
        _rule(config.check_avg, OVER_AVG, mid, v - mid, config.pct),
        _rule(config.check_min, UNDER_MIN, low, low - v, config.pct),
    )
    return slices.withColumn("type", F.explode(F.array_compact(kinds))).select(
        "type",
        *schemas.ids(level),
        "slice_gap",
        "slice_start",
        "slice_date",
        "slice_index",
        F.col("avg").alias("value"),
        F.col("prior_min").alias("min"),
        F.col("prior_avg").alias("avg"),
        F.col("prior_max").alias("max"),
    )


def alerts(
    slices: DataFrame, level: str, config: AlertConfig = AlertConfig(), start: DataFrame | None = None
) -> DataFrame:
    return alerts_from_baseline(running_baseline(slices, level, start=start), level, config)


def alert_json(level: str) -> Column:
    """The alert as the JSON message subscribers receive."""
    # The message's key names.
    named = {
        "type": F.col("type"),
        "houseId": F.col("house_id"),
        "householdId": F.col("household_id") if level != HOUSE else None,
        "deviceId": F.col("device_id") if level == DEVICE else None,
        "min": F.col("min"),
        "max": F.col("max"),
        "avg": F.col("avg"),
        "value": F.col("value"),
        "year": S.year_text(F.col("slice_date")),
        "month": S.month_text(F.col("slice_date")),
        "day": S.day_text(F.col("slice_date")),
        "sliceIndex": F.col("slice_index"),
        "sliceGap": F.col("slice_gap"),
    }
    return F.to_json(F.struct(*[c.alias(k) for k, c in named.items() if c is not None]))


# The topic an alert is published to, per level of subscriber.
_TOPICS = {
    HOUSE: ("%shouse-%d-notification", ["house_id"]),
    HOUSEHOLD: ("%shousehold-%d-%d-notification", ["house_id", "household_id"]),
    DEVICE: ("%sdevice-%d-%d-%d-notification", ["house_id", "household_id", "device_id"]),
}
_GLOBAL_TOPIC = "%siot-notification"
# A device alert also goes to its household's, its house's and the global topic, and so on up.
_ROUTES = {
    DEVICE: [HOUSE, HOUSEHOLD, DEVICE],
    HOUSEHOLD: [HOUSE, HOUSEHOLD],
    HOUSE: [HOUSE],
}


def alert_topics(alert_rows: DataFrame, level: str, prefix: str = "") -> DataFrame:
    """``(topic, value)`` messages, the shape a Kafka-style sink takes."""
    lead = F.lit(prefix)
    topics = [
        F.format_string(_TOPICS[to][0], lead, *[F.col(c) for c in _TOPICS[to][1]]) for to in _ROUTES[level]
    ]
    topics.append(F.format_string(_GLOBAL_TOPIC, lead))
    return alert_rows.select(
        F.explode(F.array(*topics)).alias("topic"), alert_json(level).alias("value")
    )


def fixed2(x: Column, nudge: float = 0.0) -> Column:
    """Two decimals; a comparison with another engine may nudge decimal ties upward."""
    return F.format_string("%.2f", x + F.lit(nudge) if nudge else x)


def _compared() -> Column:
    kind = F.col("type")
    return (
        F.when(kind == UNDER_MIN, F.col("min")).when(kind == OVER_AVG, F.col("avg")).otherwise(F.col("max"))
    )


def alert_change(nudge: float = 0.0) -> Column:
    """``+12.34W (56.78%)``: how far the value is off the figure it was compared with."""
    diff = F.col("value") - _compared()
    sign = F.when(diff < 0, "").otherwise("+")
    percent = diff * 100 / F.nullif(_compared(), F.lit(0.0))
    return F.concat(sign, fixed2(diff, nudge), F.lit("W ("), fixed2(percent, nudge), F.lit("%)"))


# The wording of titles and of the compared figure, by alert type.
_WORDING = {
    UNDER_MIN: ("under utilized", "Min"),
    OVER_AVG: ("use more power than usual", "Average"),
    OVER_MAX: ("over utilized", "Max"),
}
_SUBJECTS = {
    DEVICE: "Device %d of household %d of house %d",
    HOUSEHOLD: "Household %d of house %d",
    HOUSE: "House %d",
}


def _by_type(pick: int) -> Column:
    kind = F.col("type")
    return (
        F.when(kind == UNDER_MIN, _WORDING[UNDER_MIN][pick])
        .when(kind == OVER_AVG, _WORDING[OVER_AVG][pick])
        .otherwise(_WORDING[OVER_MAX][pick])
    )


def time_ago(then: Column, now: Column) -> Column:
    """Age of a moment in words; ``now`` is given, so the answer can be repeated."""
    seconds = F.unix_seconds(now) - F.unix_seconds(then)

    def spelled(unit_seconds, unit):
        return F.concat(F.floor(seconds / unit_seconds).cast("string"), F.lit(f" {unit}(s) ago"))

    return (
        F.when(seconds.isNull(), "Unknow")  # fixed value, spelled as the dashboard shows it
        .when(seconds < 2, "Just now")
        .when(seconds < 60, spelled(1, "second"))
        .when(seconds < 3600, spelled(60, "minute"))
        .when(seconds < 86400, spelled(3600, "hour"))
        .otherwise(spelled(86400, "day"))
    )


def alert_messages(alert_rows: DataFrame, level: str, now: Column, nudge: float = 0.0) -> DataFrame:
    """Title and body of each alert; its age counts from the end of its slice."""
    subject = F.format_string(_SUBJECTS[level], *[F.col(c) for c in reversed(schemas.ids(level))])
    label = S.slice_label(F.col("slice_date"), F.col("slice_index"), F.col("slice_gap"))
    raised = S.slice_end(F.col("slice_start"), F.col("slice_gap"))
    body = F.concat_ws(
        "\n",
        F.concat_ws(" ", subject, _by_type(0)),
        F.concat(_by_type(1), F.lit(": "), fixed2(_compared(), nudge), F.lit(" (W)")),
        F.concat(F.lit("Value: "), fixed2(F.col("value"), nudge), F.lit(" (W) ("), alert_change(nudge), F.lit(")")),
        F.concat(F.lit("Time: "), label, F.lit(" ("), time_ago(raised, now), F.lit(")")),
    )
    return alert_rows.withColumns({"title": F.concat_ws(" ", F.lit(level.capitalize()), _by_type(0)), "body": body})
