"""Exact medians of everything before a row, for rows of many series at once.

A median cannot be merged from parts, but its place can be searched for: the values of a
series are numbered by size, and all rows of the series descend together through a tree
over those numbers, ``RADIX`` ways a level. At each level a row needs only how many of the
values before it lie in each branch, which are running counts. So a series of n values costs
n times the number of levels, log n to the base ``RADIX``, and no row looks at its past twice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from wattfold.operators.running import running_position, running_totals
from wattfold.session import written

RADIX = 16
FEW = 64  # up to so many values a series takes its medians straight from a window


def _levels(most: int) -> int:
    levels = 1
    while RADIX**levels < most:
        levels += 1
    return levels


def running_medians(
    rows: DataFrame, keys: list[str], order: str, asked: Column, most: int, chunk: str | None = None
) -> DataFrame:
    """The ``asked`` rows with ``median`` and ``history`` of ``_past`` over the rows of their keys before.

    ``order`` is a number that only the row itself, and one of a pair of asking and telling rows, may
    share; a row does not see what is at its own. Null ``_past`` tell nothing. ``most`` bounds the values of a
    series, by the calendar as a rule; a longer one is an error, not a wrong median.

    Without ``chunk`` a series stays in one task. With ``chunk``, a column that rises with ``order``, it is
    counted chunk by chunk at first (see ``running_totals``) and by ranges of values from then on.
    """
    if chunk is not None:
        # Six branches of the plan read the rows; each would work them out anew.
        rows = written(rows, "medians")
        longest = rows.groupBy(*keys).agg(F.count("_past").alias("n")).agg(F.max("n")).first()[0]
        if (longest or 0) > most:
            raise ValueError(f"a series is longer than most: {longest} values")
        most = max(longest or 1, 1)
        return _searched(_numbered_apart(rows, keys), keys, order, asked, most, chunk)
    series = Window.partitionBy(*keys).orderBy(order)
    whole = series.rangeBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = series.rangeBetween(Window.unboundedPreceding, -1)
    sized = rows.withColumns({"_many": F.count("_past").over(whole), "history": F.count("_past").over(before)})
    near = F.when(F.col("_many") <= FEW, F.col("_past"))
    few = sized.withColumn("median", F.percentile(near, F.lit(0.5)).over(before)).where(asked & (F.col("_many") <= FEW))
    by_value = Window.partitionBy(*keys).orderBy(F.col("_past").asc_nulls_last())
    number = F.when(F.col("_past").isNotNull(), F.dense_rank().over(by_value) - 1)
    # Dealt anew although it lies right: where no series is long, the exchange is empty and all after it is dropped.
    many = sized.where(F.col("_many") > FEW).repartition(*[F.col(k) for k in keys]).withColumn("_number", number)
    return few.drop("_many", "_past").unionByName(_searched(many.drop("_many"), keys, order, asked, most, None))


def _numbered_apart(rows: DataFrame, keys: list[str]) -> DataFrame:
    """``rows`` with ``_number``, the place of ``_past`` among the series' distinct values.

    Numbered an eighth of an octave at a time; equal values are one.
    """
    size = F.abs("_past")
    octave = F.when(size > 0, F.signum("_past") * (F.floor(F.log2(size) * 8) + 16384)).otherwise(F.lit(0)).cast("int")
    distinct = rows.where(F.col("_past").isNotNull()).select(*keys, "_past").distinct().withColumn("_octave", octave)
    numbers = running_position(distinct, keys, "_past", "_number", "_octave").drop("_octave")
    return rows.join(numbers, [*keys, "_past"], "left")


def _searched(rows: DataFrame, keys: list[str], order: str, asked: Column, most: int, chunk: str | None) -> DataFrame:
    """Every asking row descends twice, for the lower and the upper middle of what lies before it."""
    levels = _levels(most)
    at = [c for c in rows.columns if c not in ("_past", "_number")]
    fits = F.assert_true(F.coalesce(F.col("_number") < most, F.lit(True)), F.lit("a series is longer than most"))
    telling = F.struct(F.lit(False).alias("_asks"), F.lit(0).alias("_side"), F.col("_number").cast("bigint").alias("_k"), F.col("_past").alias("_value"))
    asking = [
        F.struct(F.lit(True).alias("_asks"), F.lit(side).alias("_side"), F.lit(None).cast("bigint").alias("_k"), F.lit(None).cast("double").alias("_value"))
        for side in (0, 1)
    ]
    entries = F.array(
        F.when(F.col("_past").isNotNull() & fits.isNull(), telling), *[F.when(asked, entry) for entry in asking]
    )
    # Those asking come first at their place, so that they see only what lies before it.
    placed = rows.select(*at, F.explode(F.array_compact(entries)).alias("_e")).select(*at, "_e.*")
    place = F.col(order).cast("bigint") * 4 + F.when(F.col("_asks"), F.col("_side")).otherwise(F.lit(2))
    placed = placed.withColumns({"_place": place, "_node": F.lit(0).cast("bigint")})
    names = [f"_c{b}" for b in range(RADIX)]
    *counts, every = names
    taken = " + ".join(f"int({c} <= _k)" for c in counts)
    below = ", ".join(f"if({c} <= _k, {c}, 0)" for c in counts)
    nodes = ", ".join(f"`{k}`" for k in [*keys, "_node"])
    before = f"over (partition by {nodes} order by _place rows between unbounded preceding and 1 preceding)"
    # As SQL text: some hundred columns a level take long to build one by one.
    for level in range(levels):
        branch = f"(_k div {RADIX ** (levels - 1 - level)}L) % {RADIX}"
        placed = placed.withColumn("_branch", F.expr(f"if(_asks, null, {branch})"))
        if chunk and level == 0:
            # The one level at which a whole series is one node; from here on its values lie apart.
            totals = {c: ("count", F.expr(f"if(_branch <= {b}, 1, null)")) for b, c in enumerate(names)}
            counted = running_totals(placed, keys, "_place", totals, chunk)
        else:
            running = [f"count(if(_branch <= {b}, 1, null)) {before} as {c}" for b, c in enumerate(names)]
            counted = placed.selectExpr("*", *running)
        if level == 0:
            # What was told before is the history; whoever has none leaves the tree, and an odd number has one middle.
            if "history" not in at:
                counted, at = counted.withColumn("history", F.col(every)), [*at, "history"]
            counted = counted.withColumn("_k", F.expr("if(_asks, (history - 1 + _side) div 2, _k)"))
            counted = counted.where("not _asks or _side = 0 or (history > 0 and history % 2 = 0)")
        kept = [f"`{c}`" for c in (*at, "_asks", "_side", "_value", "_place")]
        placed = counted.selectExpr(
            *kept,
            f"if(_asks and history = 0, -1, _node * {RADIX} + if(_asks, {taken}, _branch)) as _node",
            f"if(_asks, _k - greatest({below}, 0), _k) as _k",
        )
    # A node is one number by now: the values that bear it are equal.
    last = Window.partitionBy(*keys, "_node")
    found = placed.withColumn("_found", F.max("_value").over(last)).where("_asks")
    return found.groupBy(*at).agg((F.min("_found") * 0.5 + F.max("_found") * 0.5).alias("median"))
