"""What the plans of the main operators look like: scans pruned, few exchanges, no cross joins."""

from wattfold.operators import aggregate
from wattfold.operators.alerts import alerts
from wattfold.operators.baseline import running_baseline
from wattfold.operators.history import history_all, latest_slices
from wattfold.plans.records import record_breakers
from wattfold.sources.readings import read_events, readings_from_events

SMALL = "/root/testdata/sf0.001"


def load(spark):
    return readings_from_events(read_events(spark, SMALL))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df):
    df.collect()
    return plan(df).split("Initial Plan")[0]


def test_scan_reads_four_columns_and_filters_in_the_reader(spark):
    text = plan(record_breakers(load(spark)))
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,event_type:string,value:double>" in text
    assert "Not(EqualNullSafe(event_type,error))" in text


def test_rollup_to_all_gaps_moves_base_rows_once(spark):
    text = plan(aggregate.device_slices(load(spark)))
    assert text.count("Exchange ") == 2
    last_aggregates = text[: text.index("Generate explode")]
    assert "Exchange" not in last_aggregates


def test_readings_are_combined_before_they_move(spark):
    text = plan(aggregate.device_slices(load(spark), (60,)))
    assert text.count("Exchange ") == 1
    assert "partial_sum" in text[text.index("Exchange "):]


def test_running_totals_scan_once_and_window_a_day_at_a_time(spark):
    text = final_plan(running_baseline(aggregate.level_slices(load(spark), "device"), "device"))
    assert text.count("FileScan") == 1 and "ReusedExchange" in text


def test_nothing_is_a_cross_join(spark):
    house = aggregate.level_slices(load(spark), "house")
    for df in (alerts(house, "house"), history_all(house, latest_slices(house))):
        text = final_plan(df)
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
