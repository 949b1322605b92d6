"""Time slices as column expressions.

A slice is ``(slice_gap minutes, slice_start)``. Its date, its index (counted from
midnight UTC) and its labels all follow from those two, by integer arithmetic on Unix
seconds, so nothing here depends on the session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

DAY_SECONDS = 86400


def slice_start(seconds: Column, gap_minutes: Column) -> Column:
    return F.timestamp_seconds(seconds - F.pmod(seconds, (gap_minutes * 60).cast("bigint")))


def days_since_epoch(start: Column) -> Column:
    return F.floor(F.unix_seconds(start) / F.lit(DAY_SECONDS)).cast("int")


def slice_date(start: Column) -> Column:
    return F.date_from_unix_date(days_since_epoch(start))


def slice_index(start: Column, gap_minutes: Column) -> Column:
    second_of_day = F.pmod(F.unix_seconds(start), F.lit(DAY_SECONDS))
    return F.floor(second_of_day / (gap_minutes * 60)).cast("int")


def slice_end(start: Column, gap_minutes: Column) -> Column:
    return F.timestamp_seconds(F.unix_seconds(start) + gap_minutes * 60)


def shift_slice(start: Column, gap_minutes: Column, n: int | Column) -> Column:
    """The start of the slice ``n`` slices later; rolls over midnight, month and year."""
    steps = n if isinstance(n, Column) else F.lit(n)
    return F.timestamp_seconds(F.unix_seconds(start) + steps * gap_minutes * 60)


def with_slice_parts(df: DataFrame) -> DataFrame:
    """Add ``slice_date`` and ``slice_index`` to rows that have gap and start."""
    return df.withColumns(
        {
            "slice_date": slice_date(F.col("slice_start")),
            "slice_index": slice_index(F.col("slice_start"), F.col("slice_gap")),
        }
    )


def pad2(n: Column) -> Column:
    return F.lpad(n.cast("string"), 2, "0")


def year_text(date: Column) -> Column:
    return F.lpad(F.year(date).cast("string"), 4, "0")


def month_text(date: Column) -> Column:
    return pad2(F.month(date))


def day_text(date: Column) -> Column:
    return pad2(F.dayofmonth(date))


def _clock(minutes: Column) -> Column:
    # lpad would cut longer numbers, but minutes never pass 24:00.
    return F.concat(pad2(F.floor(minutes / 60)), F.lit(":"), pad2(minutes % 60))


def clock_range(index: Column, gap_minutes: Column) -> Column:
    """``HH:mm->HH:mm``; the last slice of a day ends at ``24:00``."""
    first = index * gap_minutes
    return F.concat(_clock(first), F.lit("->"), _clock(first + gap_minutes))


def date_label(date: Column) -> Column:
    return F.concat_ws("/", year_text(date), month_text(date), day_text(date))


def slice_label(date: Column, index: Column, gap_minutes: Column) -> Column:
    """``yyyy/MM/dd HH:mm->HH:mm``."""
    return F.concat_ws(" ", date_label(date), clock_range(index, gap_minutes))


def slice_id(date: Column, index: Column, gap_minutes: Column) -> Column:
    """``yyyy-MM-dd-index-gap``."""
    return F.concat_ws(
        "-",
        year_text(date),
        month_text(date),
        day_text(date),
        index.cast("string"),
        gap_minutes.cast("string"),
    )


def parse_slice_id(text: Column) -> dict[str, Column]:
    """Columns of the slice an id names; all null where the text is no slice id."""
    parts = F.split(text, "-")
    date = F.concat_ws("-", F.get(parts, F.lit(0)), F.get(parts, F.lit(1)), F.get(parts, F.lit(2)))
    day = date.try_cast("date")
    index = F.get(parts, F.lit(3)).try_cast("int")
    gap = F.get(parts, F.lit(4)).try_cast("int")
    ok = (F.size(parts) == 5) & (gap > 0) & (index >= 0) & (index * gap < 1440)
    seconds = F.unix_date(day).cast("bigint") * DAY_SECONDS + index * gap * 60
    return {
        "slice_gap": F.when(ok & day.isNotNull(), gap),
        "slice_date": F.when(ok, day),
        "slice_index": F.when(ok & day.isNotNull(), index),
        "slice_start": F.when(ok, F.timestamp_seconds(seconds)),
    }


def entity_key(*ids: Column) -> Column:
    """``house-household-device`` text key, as far down as ids are given."""
    return F.concat_ws("-", *[i.cast("string") for i in ids])
