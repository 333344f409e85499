"""Days, Sunday-based weeks and clock slots as Column expressions."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EPOCH = date(1970, 1, 1)
ONE_DAY = timedelta(days=1)


def event_date(time: str = "time") -> Column:
    return F.to_date(time).alias("event_date")


def week_start(day: Column) -> Column:
    """The Sunday on or before ``day`` (``date_trunc('week')`` would give Mondays)."""
    return F.date_sub(day, F.dayofweek(day) - 1)


def day_number(day: date) -> int:
    return (day - EPOCH).days


def clock_slot(period: str, minutes: int) -> Column:
    """Index of a slot within its day, 0 at midnight."""
    return F.expr(f"(hour({period}) * 60 + minute({period})) div {minutes}")


def slot_number(period: str, minutes: int) -> Column:
    """Index of a slot on the whole time line: neighbours differ by 1."""
    days = F.expr(f"cast(unix_date(to_date({period})) as bigint)")
    return days * (24 * 60 // minutes) + clock_slot(period, minutes)


def runs(days: Iterable[date]) -> list[tuple[date, date]]:
    """Merge days into closed ranges, so that a filter needs few comparisons."""
    merged: list[tuple[date, date]] = []
    for day in sorted(set(days)):
        if merged and day - merged[-1][1] == ONE_DAY:
            merged[-1] = (merged[-1][0], day)
        else:
            merged.append((day, day))
    return merged


def on_days(frame: DataFrame, ranges: Iterable[tuple[date, date]]) -> DataFrame:
    """Keep the events of the given closed day ranges.

    A table laid out by ``event_date`` (see `sources.tables.write_events`) is
    pruned to the matching partitions. The bounds are compared with the raw
    ``time`` column and so reach the file scan as well, but only some readers
    can skip data by them: ORC does, Parquet does not for ``timestamp_ntz``.
    """
    keep = F.lit(False)
    for first, last in ranges:
        start = F.lit(f"{first} 00:00:00").cast("timestamp_ntz")
        end = F.lit(f"{last + ONE_DAY} 00:00:00").cast("timestamp_ntz")
        inside = (F.col("time") >= start) & (F.col("time") < end)
        if "event_date" in frame.columns:
            inside &= F.col("event_date").between(F.lit(first), F.lit(last))
        keep |= inside
    return frame.where(keep)


def up_to(frame: DataFrame, last: date) -> DataFrame:
    """Keep the events of a day and all days before it."""
    end = F.lit(f"{last + ONE_DAY} 00:00:00").cast("timestamp_ntz")
    keep = F.col("time") < end
    if "event_date" in frame.columns:
        keep &= F.col("event_date") <= F.lit(last)
    return frame.where(keep)
