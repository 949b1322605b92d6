from datetime import date

import pytest
from pyspark.sql import functions as F

from wattfold import schemas
from wattfold.operators.alerts import alerts
from wattfold.sinks.tables import TableStore, write_messages


@pytest.fixture
def store(spark, tmp_path):
    return TableStore(spark, str(tmp_path / "tables"))


def stored(store, name="house_data"):
    return {(str(r.slice_start), r.house_id): r.avg for r in store.read(name).collect()}


def test_missing_table_is_empty(store):
    assert store.read("house_data").isEmpty()
    assert store.read("house_data").schema.names == schemas.TABLES["house_data"].columns


def test_upsert_inserts_and_replaces(store, slices):
    store.upsert("house_data", slices("house", 60, ("2024-01-01 00:00:00", 1), ("2024-01-01 01:00:00", 2), ("2024-01-02 00:00:00", 3)))
    store.upsert("house_data", slices("house", 60, ("2024-01-01 01:00:00", 20), ("2024-01-03 00:00:00", 4), ("2024-01-01 01:00:00", 7, 1)))
    assert stored(store) == {
        ("2024-01-01 00:00:00", 0): 1,
        ("2024-01-01 01:00:00", 0): 20,
        ("2024-01-01 01:00:00", 1): 7,
        ("2024-01-02 00:00:00", 0): 3,
        ("2024-01-03 00:00:00", 0): 4,
    }


def test_upsert_leaves_other_partitions_alone(store, slices):
    store.upsert("house_data", slices("house", 60, ("2024-01-01 00:00:00", 1), ("2024-01-02 00:00:00", 3)))
    files = {r[0] for r in store.read("house_data").where("slice_date = '2024-01-02'").select(F.input_file_name()).collect()}
    rows = slices("house", 60, ("2024-01-01 00:00:00", 9))
    store.upsert("house_data", rows)
    store.upsert("house_data", rows)
    again = {r[0] for r in store.read("house_data").where("slice_date = '2024-01-02'").select(F.input_file_name()).collect()}
    assert files == again and store.read("house_data").count() == 2


def test_upsert_of_nothing(store, slices):
    empty = slices("house", 60, ("2024-01-01 00:00:00", 1)).where("false")
    store.upsert("house_data", empty)
    store.upsert("house_data", slices("house", 60, ("2024-01-01 00:00:00", 1)))
    store.upsert("house_data", empty)
    assert len(stored(store)) == 1


def test_alerts_of_one_slice_are_kept_by_type(store, slices):
    rows = alerts(slices("house", 60, ("2024-01-01 00:00:00", 1), ("2024-01-01 01:00:00", 9)), "house")
    store.upsert("house_notification", rows)
    store.upsert("house_notification", rows)
    assert {r.type for r in store.read("house_notification").collect()} == {0, 1}
    assert store.read("house_notification").count() == 2


def test_forecasts_are_kept_by_version(store, slices):
    rows = slices("house", 60, ("2024-01-01 00:00:00", 1))
    for version in ("v0", "v1", "v0"):
        store.upsert("house_data_forecast", rows.withColumn("version", F.lit(version)))
    assert store.read("house_data_forecast").count() == 2
    assert store.forecast_versions("house") == ["v0", "v1"]
    with pytest.raises(ValueError):
        store.purge_forecast_version("v0")
    store.purge_forecast_version("v0", confirm=True)
    assert [r.version for r in store.read("house_data_forecast").collect()] == ["v1"]


def test_replace_can_empty_a_partition(store, slices):
    store.upsert("house_data", slices("house", 60, ("2024-01-01 00:00:00", 1), ("2024-01-02 00:00:00", 2), ("2024-01-02 00:00:00", 3, 1)))
    since = date(2024, 1, 2)
    owner = slices("house", 60, ("2024-01-02 00:00:00", 2)).select("house_id")
    nothing = slices("house", 60, ("2024-01-01 00:00:00", 1)).where("false")
    store.replace("house_data", nothing, first=since, owners=owner)
    assert stored(store) == {("2024-01-01 00:00:00", 0): 1, ("2024-01-02 00:00:00", 1): 3}
    store.replace("house_data", nothing, first=since)
    assert stored(store) == {("2024-01-01 00:00:00", 0): 1}


def test_an_upsert_that_fails_changes_nothing(store, slices):
    store.upsert("house_data", slices("house", 60, ("2024-01-01 00:00:00", 1), ("2024-01-02 00:00:00", 2)))
    second = slices("house", 60, ("2024-01-01 00:00:00", 10), ("2024-01-02 00:00:00", 20))
    broken = second.withColumn("avg", F.when(F.col("avg") > 15, F.raise_error(F.lit("lost"))).otherwise(F.col("avg")))
    with pytest.raises(Exception, match="lost"):
        store.upsert("house_data", broken)
    assert sorted(stored(store).values()) == [1, 2]
    store.upsert("house_data", second)
    store.upsert("house_data", second)
    assert sorted(stored(store).values()) == [10, 20]


def test_dates_far_apart_are_listed(store, slices):
    store.upsert("house_data", slices("house", 60, ("2024-01-01 00:00:00", 1), ("2064-01-02 00:00:00", 2)))
    looked = []
    there = store._exists
    store._exists = lambda path: looked.append(path) or there(path)
    assert store.read("house_data", date(2024, 1, 1), date(2064, 1, 2)).count() == 2
    assert not looked


def test_init_and_purge(store, slices, spark):
    store.init_tables()
    store.upsert("house_data", slices("house", 60, ("2024-01-01 00:00:00", 1)))
    store.init_tables()
    assert len(stored(store)) == 1
    store.register_views()
    assert spark.sql("SELECT count(*) FROM house_data WHERE slice_gap = 60").first()[0] == 1
    store.init_tables(purge=True)
    assert stored(store) == {}


def test_messages_go_to_a_folder_per_topic(spark, tmp_path):
    rows = spark.createDataFrame([("a", "x"), ("b", "y")], "topic string, value string")
    write_messages(rows, str(tmp_path / "out"))
    assert {(r.topic, r.value) for r in spark.read.text(str(tmp_path / "out")).collect()} == {("a", "x"), ("b", "y")}


def test_reading_a_range_of_dates(store, slices):
    days = [(f"2024-01-{d:02d} 00:00:00", d) for d in (1, 2, 9)]
    store.upsert("house_data", slices("house", 60, *days))

    def found(**kw):
        return sorted(r.avg for r in store.read("house_data", **kw).collect())

    assert found(first=date(2024, 1, 2)) == [2, 9]
    assert found(last=date(2024, 1, 2)) == [1, 2]
    assert found(first=date(2024, 1, 2), last=date(2024, 1, 9)) == [2, 9]
    assert found(first=date(2024, 1, 3), last=date(2024, 1, 4)) == []
    assert store.newest_date("house_data") == date(2024, 1, 9)


def test_reads_of_stored_tables_prune_partitions(store, slices):
    from wattfold.plans.reads import query_slices

    store.upsert("house_data", slices("house", 60, ("2024-01-01 00:00:00", 1), ("2024-02-01 00:00:00", 2)))
    df = query_slices({"house": store.read("house_data")}, month=2, slice_gap=60, slice_index=0)
    plan = df._jdf.queryExecution().executedPlan().toString()
    partition = plan[plan.index("PartitionFilters"):plan.index("PushedFilters")]
    assert "slice_gap" in partition and "month" in partition
    assert "EqualTo(slice_index,0)" in plan
    assert df.count() == 1
