"""Running totals over a long series, a day at a time.

A plain window over one entity's whole history would put that history into one task. The
totals here are mergeable, so a row's total is that of the days before it (one row per
day) merged with that of its own day so far (a day's rows at most per task group).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

def _add(a: Column, b: Column) -> Column:
    return F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0))


def _add_decimals(a: Column, b: Column) -> Column:
    # At full precision an addition would give up a decimal place to make room.
    return _add(*[x.cast("decimal(36,15)") for x in (a, b)])


# Per kind of total: the aggregate over rows, over per-day results, and the merge of two.
_KINDS = {
    "min": (F.min, F.min, F.least),
    "max": (F.max, F.max, F.greatest),
    "sum": (F.sum, F.sum, _add_decimals),
    "count": (F.count, F.sum, _add),
}


def running_totals(
    rows: DataFrame,
    keys: list[str],
    order: str,
    totals: dict[str, tuple[str, Column]],
    chunk: str = "slice_date",
    start: DataFrame | None = None,
) -> DataFrame:
    """Add, per row, totals over the rows of the same ``keys`` strictly before it.

    ``totals`` maps an output name to ``(kind, expression)``; a total is null (0 for
    counts and sums) where nothing comes before. ``start`` may hold totals carried over
    from earlier rows, one row per ``keys``, under the same names.
    """
    # Both branches below are to read one exchange, rows of a key and day together. So the
    # null test the join would add to one of them comes first, and the per-day branch
    # counts over every column, lest column pruning make two different exchanges of it.
    known = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in [*keys, chunk]])
    placed = rows.where(known).repartition(*[F.col(c) for c in [*keys, chunk]])
    placed = placed.withColumns({f"_in_{name}": expr for name, (_, expr) in totals.items()})

    within = Window.partitionBy(*keys, chunk).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    day = placed.withColumns(
        {f"_day_{n}": _KINDS[kind][0](F.col(f"_in_{n}")).over(within) for n, (kind, _) in totals.items()}
    ).drop(*[f"_in_{n}" for n in totals])

    per_day = placed.groupBy(*keys, chunk).agg(
        F.call_function("count", *[F.col(c) for c in rows.columns]).alias("_rows"),
        *[_KINDS[kind][0](F.col(f"_in_{n}")).alias(n) for n, (kind, _) in totals.items()],
    )
    earlier = Window.partitionBy(*keys).orderBy(chunk).rowsBetween(Window.unboundedPreceding, -1)
    before = per_day.where(F.col("_rows") >= 0).select(
        *keys,
        chunk,
        *[_KINDS[kind][1](F.col(n)).over(earlier).alias(f"_before_{n}") for n, (kind, _) in totals.items()],
    )
    joined = day.join(before, [*keys, chunk])
    parts = {n: [f"_before_{n}", f"_day_{n}"] for n in totals}
    if start is not None:
        carried = start.select(*keys, *[F.col(n).alias(f"_start_{n}") for n in totals])
        joined = joined.join(carried, keys, "left")
        parts = {n: [f"_start_{n}", *cols] for n, cols in parts.items()}
    merged = {
        n: reduce(_KINDS[kind][2], [F.col(c) for c in parts[n]]) for n, (kind, _) in totals.items()
    }
    return joined.withColumns(merged).drop(*[c for cols in parts.values() for c in cols])


def running_position(rows: DataFrame, keys: list[str], order: str, name: str, chunk: str = "slice_date") -> DataFrame:
    """Zero-based position of each row in its series."""
    return running_totals(rows, keys, order, {name: ("count", F.lit(1))}, chunk)
