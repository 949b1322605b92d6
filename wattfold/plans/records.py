"""The flagship question: which slices beat an entity's previous record?"""

from __future__ import annotations

from pyspark.sql import DataFrame

from wattfold.config import HOUSE, SHIPPED_ALERTS, AlertConfig
from wattfold.operators.aggregate import level_slices
from wattfold.operators.alerts import alerts


def record_breakers(
    readings: DataFrame, level: str = HOUSE, gap: int = 120, config: AlertConfig = SHIPPED_ALERTS
) -> DataFrame:
    return alerts(level_slices(readings, level, (gap,)), level, config)
