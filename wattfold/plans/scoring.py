"""The scoring job: scores of stored forecasts, from the days that changed."""

from __future__ import annotations

from wattfold.config import HOUSE
from wattfold.operators.stats import daily_moments, merged_scores
from wattfold.sinks.tables import TableStore


def score_stored(store: TableStore, versions=None, first=None, last=None) -> None:
    """Bring the stored scores up to date after slices of the dates ``first`` to ``last`` changed.

    Only those days' slices and forecasts are read; what every other day adds to a score is
    stored. Without dates all days are scored anew. ``versions`` are those stored if not named.
    """
    versions = tuple(versions or store.forecast_versions(HOUSE))
    if not versions:
        return
    actual = store.read(f"{HOUSE}_data", first, last)
    said = store.read(f"{HOUSE}_data_forecast", first, last)
    store.replace("forecast_moments", daily_moments(actual, said, versions), first, last)
    store.upsert("forecast_meta_data", merged_scores(store.read("forecast_moments")))
