"""Figures that a stream hands out as its batches end, without a second pass."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

STATUSES = ("queued", "processing", "retry_wait", "completed", "failed", "retired")


def with_figures(stream: DataFrame, name: str, time: str, status: str | None = None) -> DataFrame:
    """The stream, observed: rows, the greatest ``time`` and, with ``status``, rows by status of every batch."""
    counts = [F.count_if(F.col(status) == s).alias(s) for s in STATUSES] if status else []
    return stream.observe(name, F.count(F.lit(1)).alias("rows"), F.max(F.unix_micros(F.col(time).cast("timestamp"))).alias("mark_us"), *counts)


class Figures(StreamingQueryListener):
    """Keeps the high-water mark, which never goes back, and sums by status of what ``name`` observed.

    A batch that is run again after a failure has the same number and counts
    once. Add it by ``spark.streams.addListener`` before the query starts.
    """

    def __init__(self, name: str, previous_us: int | None = None):
        self.name, self.mark_us, self.batches = name, previous_us, {}

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        row = event.progress.observedMetrics.get(self.name)
        if row is not None:
            self.batches[event.progress.batchId] = row.asDict()
            if row.mark_us is not None:
                self.mark_us = row.mark_us if self.mark_us is None else max(self.mark_us, row.mark_us)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def totals(self) -> dict[str, int]:
        """Rows, and rows by status, of all batches so far."""
        out: dict[str, int] = {}
        for row in self.batches.values():
            for k, n in row.items():
                if k != "mark_us":
                    out[k] = out.get(k, 0) + (n or 0)
        return out
