import pytest
from pyspark.sql import functions as F

from wattfold.config import DEFAULT_GAPS
from wattfold.operators import aggregate as A


def test_device_slices_by_hand(readings):
    rows = readings(
        ("2024-01-01T00:00:10", 10),
        ("2024-01-01T00:00:50", 20),
        ("2024-01-01T00:01:00", 0),
        ("2024-01-01T00:01:00", 99, 0, 0, 0, 0),  # not a load reading
        ("2024-01-01T00:01:00", 7, 0, 0, 1),
    )
    got = {
        tuple(r[:3]): tuple(r[3:])
        for r in A.device_slices(rows, (1, 5))
        .select("device_id", "slice_gap", "slice_index", "value", "count", "avg")
        .collect()
    }
    assert got == {
        (0, 1, 0): (30.0, 2.0, 15.0),
        (0, 1, 1): (0.0, 1.0, 0.0),
        (0, 5, 0): (30.0, 3.0, 10.0),
        (1, 1, 1): (7.0, 1.0, 7.0),
        (1, 5, 0): (7.0, 1.0, 7.0),
    }


def test_same_device_number_in_two_households_stays_apart(readings):
    rows = readings(("2024-01-01T00:00:00", 1, 0, 0, 5), ("2024-01-01T00:00:00", 2, 0, 1, 5), ("2024-01-01T00:00:00", 4, 1, 0, 5))
    device = A.device_slices(rows, (60,))
    assert device.count() == 3
    assert sorted(r.avg for r in A.household_slices(device).collect()) == [1, 2, 4]
    assert sorted(r.avg for r in A.house_slices(device).collect()) == [3, 4]


def test_household_is_the_sum_of_averages_not_the_average(readings):
    rows = readings(
        ("2024-01-01T00:00:00", 10), ("2024-01-01T00:30:00", 30), ("2024-01-01T00:00:00", 5, 0, 0, 1)
    )
    assert A.house_slices(A.device_slices(rows, (60,))).first().avg == 25


def test_one_gap_and_many_gaps_agree(small_readings):
    many = A.device_slices(small_readings, DEFAULT_GAPS)
    for gap in (1, 15, 120):
        one = A.device_slices(small_readings, (gap,))
        same = many.where(F.col("slice_gap") == gap).select(*one.columns)
        assert one.exceptAll(same).isEmpty() and same.exceptAll(one).isEmpty()


def test_totals_agree_over_levels_and_gaps(small_readings):
    device = A.device_slices(small_readings).cache()
    loads = small_readings.where("property = 1")
    n, total = loads.agg(F.count("*"), F.sum("value")).first()
    for r in device.groupBy("slice_gap").agg(F.sum("count").alias("n"), F.sum("value").alias("v")).collect():
        assert r.n == n and r.v == pytest.approx(total)
    sums = [df.groupBy("slice_gap").agg(F.sum("avg").alias("s")) for df in (device, A.household_slices(device), A.house_slices(device))]
    per_gap = [{r.slice_gap: r.s for r in s.collect()} for s in sums]
    for gap in DEFAULT_GAPS:
        assert per_gap[0][gap] == pytest.approx(per_gap[1][gap]) == pytest.approx(per_gap[2][gap])


def test_hierarchy_matches_the_single_levels(small_readings):
    device = A.device_slices(small_readings, (60, 120)).cache()
    both = A.hierarchy_rollup(device)
    house = A.house_slices(device)
    got = both.where("level = 'house'").select(*house.columns)
    assert got.exceptAll(house).isEmpty() and house.exceptAll(got).isEmpty()
    assert both.where("level = 'household'").count() == A.household_slices(device).count()


def test_sums_do_not_depend_on_row_order(readings):
    values = [0.1, 0.2, 0.3, 0.7, 1.1, 2.3, 1e6, 0.01]
    rows = [("2024-01-01T00:00:00", v, 0, 0, i) for i, v in enumerate(values)]
    one = A.house_slices(A.device_slices(readings(*rows), (60,))).first().avg
    other = A.house_slices(A.device_slices(readings(*reversed(rows)), (60,)).repartition(7)).first().avg
    assert one == other == 1000004.71


def test_stale_needs_house_and_household_idle(readings):
    rows = readings(("2024-01-01T00:00:00", 1), ("2024-01-01T00:10:00", 1, 1, 0, 0))
    now = F.lit("2024-01-01 00:06:30").cast("timestamp")
    got = A.stale_slices(rows, now, (1, 60)).collect()
    assert [(r.slice_gap, r.slice_index) for r in got] == [(1, 0)]


def test_rollup_holds_no_table_of_slices(spark, small_readings):
    """After the one exchange the widths are read off a sorted walk, not gathered in a hash table."""
    rolled = A.rollup_base(A.base_slices(small_readings))
    plan = rolled._jdf.queryExecution().executedPlan().toString()
    above = plan[: plan.index("Exchange")]
    assert "Window" in above and "Aggregate" not in above


def test_rollup_of_full_blocks_adds_up(spark):
    """Gapless, negative and repeated base slices, widths that do not nest, over a day's end."""
    import random
    from collections import defaultdict
    from decimal import Decimal

    draw = random.Random(5)
    start = 1704067200 + 22 * 3600
    rows = [(0, 0, d, start + 60 * m, Decimal(draw.randrange(-10**9, 10**13)).scaleb(-6), draw.randrange(1, 9)) for d in range(2) for m in range(250)]
    rows += rows[:40]
    base = spark.createDataFrame(rows, "house_id int, household_id int, device_id int, at bigint, total decimal(38,15), count bigint")
    base = base.withColumn("slice_start", F.timestamp_seconds("at")).drop("at").repartition(3)
    gaps = (1, 15, 20, 45)
    want = defaultdict(lambda: [Decimal(0), 0])
    for _, _, device, at, total, n in rows:
        for gap in gaps:
            have = want[device, gap, at - at % (gap * 60)]
            have[0], have[1] = have[0] + total, have[1] + n
    got = A.rollup_base(base, gaps).withColumn("at", F.unix_seconds("slice_start")).collect()
    assert {(r.device_id, r.slice_gap, r["at"]): (r.value, r["count"]) for r in got} == {
        k: (float(total), n) for k, (total, n) in want.items()
    }
    assert len(got) == len(want)
