"""Every table's columns and key, declared once."""

from __future__ import annotations

from pyspark.sql import types as T

from wattfold.config import DEVICE, HOUSE, HOUSEHOLD, LEVELS

IDS = {
    HOUSE: ("house_id",),
    HOUSEHOLD: ("house_id", "household_id"),
    DEVICE: ("house_id", "household_id", "device_id"),
}


def ids(level: str) -> list[str]:
    return list(IDS[level])


def series_keys(level: str) -> list[str]:
    """One time series: the full path of ids and the slice width."""
    return [*IDS[level], "slice_gap"]


def slice_keys(level: str) -> list[str]:
    return [*IDS[level], "slice_gap", "slice_start"]


READING = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("timestamp", T.LongType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("property", T.IntegerType()),
        T.StructField("plug_id", T.IntegerType()),
        T.StructField("household_id", T.IntegerType()),
        T.StructField("house_id", T.IntegerType()),
    ]
)

INGEST_SNAPSHOT = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("connect", T.BooleanType()),
        T.StructField("totalSpeed", T.DoubleType()),
        T.StructField("loadSpeed", T.DoubleType()),
        T.StructField("total", T.LongType()),
        T.StructField("load", T.LongType()),
        T.StructField("queue", T.LongType()),
        T.StructField("success", T.LongType()),
        T.StructField("fail", T.LongType()),
    ]
)


def _ids(level):
    return [T.StructField(c, T.IntegerType(), False) for c in IDS[level]]


def _doubles(*names):
    return [T.StructField(n, T.DoubleType()) for n in names]


_SLICE = [
    T.StructField("slice_start", T.TimestampType(), False),
    T.StructField("slice_index", T.IntegerType(), False),
]
_PARTS = [
    T.StructField("slice_gap", T.IntegerType(), False),
    T.StructField("slice_date", T.DateType(), False),
]
PARTITIONS = ("slice_gap", "slice_date")


class Table:
    """A stored table: its schema (partition columns last), key and partitioning."""

    def __init__(self, name, fields, key, partitions):
        self.name = name
        self.schema = T.StructType(fields)
        self.key = list(key)
        self.partitions = list(partitions)

    @property
    def columns(self):
        return self.schema.names


def _tables() -> dict[str, Table]:
    out = {}

    def add(name, fields, key, partitions):
        out[name] = Table(name, fields, key, partitions)

    # Running sums per device and base slice, from which every wider slice is rolled up.
    add(
        "device_base",
        [
            *_ids(DEVICE),
            T.StructField("slice_start", T.TimestampType(), False),
            T.StructField("total", T.DecimalType(38, 15)),
            T.StructField("count", T.LongType()),
            T.StructField("slice_date", T.DateType(), False),
        ],
        [*IDS[DEVICE], "slice_start"],
        ["slice_date"],
    )
    for level in LEVELS:
        key = slice_keys(level)
        amounts = _doubles("value", "count", "avg") if level == DEVICE else _doubles("avg")
        add(f"{level}_data", [*_ids(level), *_SLICE, *amounts, *_PARTS], key, PARTITIONS)
        add(
            f"{level}_data_forecast",
            [*_ids(level), *_SLICE, *_doubles("avg"), T.StructField("version", T.StringType(), False), *_PARTS],
            [*key, "version"],
            ["version", *PARTITIONS],
        )
        add(
            f"{level}_notification",
            [
                T.StructField("type", T.IntegerType(), False),
                *_ids(level),
                *_SLICE,
                *_doubles("value", "min", "avg", "max"),
                *_PARTS,
            ],
            ["type", *key],
            PARTITIONS,
        )
        add(
            f"{level}_prop",
            [
                *_ids(level),
                *_doubles("min", "avg", "max"),
                T.StructField("total", T.DecimalType(38, 15)),
                T.StructField("count", T.LongType()),
                T.StructField("through", T.DateType()),
                T.StructField("slice_gap", T.IntegerType(), False),
            ],
            series_keys(level),
            ["slice_gap"],
        )
    add(
        "forecast_meta_data",
        [
            T.StructField("slice_gap", T.IntegerType(), False),
            T.StructField("count", T.LongType()),
            *_doubles("mean", "variance", "standard_deviation", "mse"),
            T.StructField("version", T.StringType(), False),
        ],
        ["slice_gap", "version"],
        ["version"],
    )
    # What a day adds to a score, from which scores of all days are merged.
    add(
        "forecast_moments",
        [
            T.StructField("slice_gap", T.IntegerType(), False),
            T.StructField("forecasts", T.LongType()),
            T.StructField("count", T.LongType()),
            *_doubles("mean", "squares"),
            T.StructField("pairs", T.LongType()),
            *_doubles("error"),
            T.StructField("version", T.StringType(), False),
            T.StructField("slice_date", T.DateType(), False),
        ],
        ["slice_gap", "version", "slice_date"],
        ["slice_date"],
    )
    add(
        "flush_metrics",
        [
            T.StructField("level", T.StringType(), False),
            T.StructField("slice_gap", T.IntegerType(), False),
            T.StructField("slices_saved", T.LongType()),
            T.StructField("alerts_raised", T.LongType()),
            T.StructField("readings_late", T.LongType()),
            T.StructField("seconds", T.DoubleType()),
            T.StructField("batch_id", T.LongType(), False),
            # The newest date the batch changed, so that a batch done twice replaces itself.
            T.StructField("slice_date", T.DateType(), False),
        ],
        ["level", "slice_gap", "batch_id"],
        ["slice_date"],
    )
    return out


TABLES = _tables()
