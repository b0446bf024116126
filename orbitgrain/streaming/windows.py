"""Windowed jobs over event streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def window_counts(events: DataFrame, width: str = "1 day", late: str = "72 hours", time: str = "ts", kind: str = "status") -> DataFrame:
    """Counts by tumbling window and status; a window is final once the watermark has passed it."""
    timed = events.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, late)
    return timed.groupBy(F.window(time, width), kind).agg(F.count(F.lit(1)).alias("n")).select(F.col("window.start").alias("start"), F.col("window.end").alias("end"), kind, "n")


def backfill_windows(start, end, days: int = 1) -> list[tuple]:
    """Fixed windows from start to end, the last one cut."""
    from datetime import timedelta

    if end <= start:
        raise ValueError("the end must come after the start")
    out, at = [], start
    while at < end:
        out.append((at, min(at + timedelta(days=days), end)))
        at += timedelta(days=days)
    return out


def run_backfill(windows: list[tuple], cursor, process, start=None):
    """``process(start, end)`` for windows from the cursor on; stops at one that is not finished, and returns the new cursor.

    ``process`` writes its own partition and says whether the window has no
    active job and no error. A cursor outside the plan is refused.
    """
    if start is not None and windows and windows[0][0] != start:
        raise ValueError("the stored plan starts elsewhere")
    for a, b in windows:
        if cursor is not None and b <= cursor:
            continue
        if not process(a, b):
            return cursor
        cursor = b
    return cursor
