import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from wattfold.session import build_session

    session = build_session(
        "wattfold-tests",
        "local[8]",
        **{"spark.sql.shuffle.partitions": "4", "spark.ui.showConsoleProgress": "false"},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(autouse=True)
def no_cache_left(spark):
    """What a test caches would otherwise serve the same plans of later tests."""
    yield
    spark.catalog.clearCache()


@pytest.fixture(scope="session")
def small_readings(spark):
    from wattfold.sources.readings import read_events, readings_from_events

    return readings_from_events(read_events(spark, SMALL))


@pytest.fixture
def readings(spark):
    """Build readings from ``(time text, value[, house, household, plug, property])`` rows."""
    from datetime import datetime, timezone

    from wattfold import schemas

    def build(*rows):
        out = []
        for i, (when, value, *rest) in enumerate(rows):
            house, household, plug, prop = [*rest, *[0, 0, 0, 1][len(rest):]]
            at = datetime.fromisoformat(when).replace(tzinfo=timezone.utc)
            out.append((i, int(at.timestamp()), float(value), prop, plug, household, house))
        return spark.createDataFrame(out, schemas.READING)

    return build


@pytest.fixture
def slices(spark):
    """Build slices of one level from ``(time text, avg[, house, household, device])`` rows."""
    from pyspark.sql import functions as F

    from wattfold import schemas
    from wattfold.functions.slices import with_slice_parts

    def build(level, gap, *rows):
        ids = schemas.ids(level)
        data = [(when, float(avg), *[*rest, 0, 0, 0][: len(ids)]) for when, avg, *rest in rows]
        columns = ", ".join(f"{c} int" for c in ids)
        df = spark.createDataFrame(data, f"at string, avg double, {columns}")
        df = df.withColumns({"slice_gap": F.lit(gap), "slice_start": F.col("at").cast("timestamp")})
        return with_slice_parts(df).select(
            *ids, "slice_gap", "slice_start", "slice_date", "slice_index", "avg"
        )

    return build
