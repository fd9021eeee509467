"""Intervals on a time axis. All intervals are half open."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callweave.functions import times as tm


def slice_intervals(df: DataFrame, start: str, end: str, seconds: int, slot: str = "slot") -> DataFrame:
    """Cut intervals at slot borders and clip both ends; ``timeDiff`` is the seconds inside the slot.

    Done row by row: an interval becomes one row per slot it touches. Empty intervals vanish.
    """
    first = F.floor(F.unix_timestamp(start) / seconds) * seconds
    last = F.floor((F.unix_timestamp(end) - 1) / seconds) * seconds
    starts = F.transform(F.sequence(first, last, F.lit(seconds).cast("long")), F.timestamp_seconds)
    out = df.filter(F.col(start) < F.col(end)).withColumn(slot, F.explode(starts))
    stop = F.timestamp_add("SECOND", F.lit(seconds), F.col(slot))
    clipped = out.withColumns({start: F.greatest(F.col(start), F.col(slot)), end: F.least(F.col(end), stop)})
    return clipped.withColumn("timeDiff", F.unix_timestamp(end) - F.unix_timestamp(start))


def split_days(df: DataFrame, start: str, end: str, day: str = "day") -> DataFrame:
    """Cut local-time intervals at midnight; a piece that goes on ends at 23:59:59 of its day."""
    days = F.sequence(F.to_date(start), F.to_date(end), F.expr("interval 1 day"))
    out = df.filter(F.col(start) <= F.col(end)).withColumn(day, F.explode(days))
    begin = F.when(F.to_date(start) < F.col(day), F.col(day).cast("timestamp")).otherwise(F.col(start))
    last_second = F.date_add(F.col(day), 1).cast("timestamp") - F.expr("interval 1 second")
    stop = F.when(F.to_date(end) > F.col(day), last_second).otherwise(F.col(end))
    return out.withColumns({start: begin, end: stop})


def starts_per_slot(
    df: DataFrame, keys: Sequence[str], at: str, seconds: int, axis_start: str | None = None, axis_end: str | None = None
) -> DataFrame:
    """Starts per key and slot on a dense axis [axis_start, axis_end); a slot without a start counts 0.

    Without bounds the axis spans the days of the data.
    """
    first, last = (df.agg(F.date_trunc("day", f(at)).alias("d")).scalar() for f in (F.min, F.max))
    lo = F.to_timestamp(F.lit(axis_start)) if axis_start else first
    hi = F.to_timestamp(F.lit(axis_end)) if axis_end else last + F.expr("interval 1 day")
    step = F.make_dt_interval(secs=F.lit(float(seconds)))
    counted = (
        df.filter((F.col(at) >= lo) & (F.col(at) < hi))
        .groupBy(*keys, tm.slot_start(F.col(at), seconds).alias("slot"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    axis = F.explode(F.sequence(lo, hi - step, step)).alias("slot")
    grid = df.select(*keys).distinct().select(*keys, axis)
    return grid.join(counted, [*keys, "slot"], "left").withColumn("n", F.coalesce("n", F.lit(0).cast("long")))


def covered_hours(df: DataFrame, start: str, end: str, label: str = "TimeIntervalStart") -> DataFrame:
    """One row per clock hour that [start, end] touches, with an hour label.

    The labels follow the dashboards: the first and the last hour carry their own bounds, an hour in
    between carries the bounds of the hour after it.
    """
    first, last = F.date_trunc("hour", start), F.date_trunc("hour", end)
    hours = ((F.unix_timestamp(last) - F.unix_timestamp(first)) / 3600).cast("int")
    out = df.withColumns({"_first": first, "_n": hours}).withColumn("hourNo", F.explode(F.sequence(F.lit(0), F.col("_n"))))
    own = (F.col("hourNo") == 0) | (F.col("hourNo") == F.col("_n"))
    at = F.col("hourNo") + F.when(own, 0).otherwise(1)

    def clock(n):
        return F.date_format(F.timestamp_add("HOUR", n, F.col("_first")), "HH:mm:ss")

    return out.withColumn(label, F.concat_ws(" - ", clock(at), clock(at + 1))).drop("_first", "_n")


def offset_interval(start: Column, from_seconds: Column, to_seconds: Column) -> tuple[Column, Column]:
    """Offsets in seconds to absolute start and end."""
    return tm.shifted(start, from_seconds), tm.shifted(start, to_seconds)


def close_open(end: Column, window_end: Column | str) -> Column:
    """Open intervals end with the extract window."""
    return F.coalesce(end, F.to_timestamp(F.lit(window_end)) if isinstance(window_end, str) else window_end)
