"""Incremental ingestion."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orbitgrain.operators.state import TERMINAL
from orbitgrain.operators.upserts import latest_rows


def stream_of(spark: SparkSession, path: str, schema, files_per_batch: int | None = None) -> DataFrame:
    """A stream of Parquet files below a folder."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def new_items(items: DataFrame, time: str = "acquired", overlap: str = "72 hours") -> DataFrame:
    """Each item once within the overlap; later ones are for the daily anti-join."""
    return items.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, overlap).dropDuplicatesWithinWatermark(["item_id"])


def without_ignored(items: DataFrame, ignored: DataFrame) -> DataFrame:
    """Stream against the table that the bootstrap wrote."""
    return items.join(ignored.select("item_id"), "item_id", "left_anti")


def run_available(stream: DataFrame, checkpoint: str, each: Callable[[DataFrame, int], None], mode: str = "append") -> None:
    """Process what is there, batch by batch, and stop."""
    query = stream.writeStream.outputMode(mode).trigger(availableNow=True).option("checkpointLocation", checkpoint).foreachBatch(each).start()
    query.awaitTermination()


STATE_OUT = "item_id long, status string, attempts int, next_attempt_at timestamp, last_event long"
STATE = "status string, attempts int, next_us long, last_event long"


def advance(state: tuple, events: pd.DataFrame, max_attempts: int, base: float, longest: float) -> tuple:
    """The batch rule of ``operators.state.step`` on one item's new events, in order of event_id."""
    status, attempts, due, last = state
    for e in events.sort_values("event_id").itertuples(index=False):
        if status in TERMINAL or (last is not None and e.event_id <= last):
            continue  # ended, or a replay
        if e.outcome == "completed":
            status, due = "completed", None
        elif e.outcome in ("error", "throttled"):
            throttled = e.outcome == "throttled"
            wait = (900.0 if pd.isna(e.retry_after) else float(e.retry_after)) if throttled else min(longest, base * 2.0 ** min(attempts, 60))
            attempts += 1
            if attempts >= max_attempts:
                status, due = ("retired" if throttled else "failed"), None
            else:
                status, due = "retry_wait", e.ts.value // 1000 + int(wait * 1_000_000)
        else:
            status, due = "queued", None
        last = int(e.event_id)
    return status, attempts, due, last


def job_states(events: DataFrame, max_attempts: int = 5, base: float = 60.0, longest: float = 3600.0) -> DataFrame:
    """Stream of (item_id, event_id, ts, outcome, retry_after) to each item's state after every batch.

    State is kept by item for good, since a job may come back at any time; a
    replayed event changes nothing.
    """
    from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

    def fold(key, frames, state: GroupState):
        now = tuple(state.get) if state.exists else ("queued", 0, None, None)
        now = (now[0], now[1], None if now[2] is None or pd.isna(now[2]) else int(now[2]), None if now[3] is None or pd.isna(now[3]) else int(now[3]))
        rows = pd.concat(list(frames))
        now = advance(now, rows, max_attempts, base, longest)
        state.update(now)
        due = pd.to_datetime([now[2]], unit="us") if now[2] is not None else pd.to_datetime([None])
        yield pd.DataFrame({"item_id": [key[0]], "status": [now[0]], "attempts": [now[1]], "next_attempt_at": due, "last_event": pd.array([now[3]], "Int64")})

    return events.groupBy("item_id").applyInPandasWithState(fold, STATE_OUT, STATE, "update", GroupStateTimeout.NoTimeout)


def keep_latest(path: str, order: str = "batch_id") -> Callable[[DataFrame, int], None]:
    """A foreachBatch step that sets each batch down as a partition of its own.

    What a batch writes grows with the batch alone, and a replay of a batch
    writes its partition again; :func:`read_latest` gives the last row of each
    key, :func:`compact` makes one partition of all so far.
    """

    def each(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path.rstrip('/')}/{order}={batch_id}")

    return each


def read_latest(spark: SparkSession, path: str, keys: list[str], order: str = "batch_id") -> DataFrame:
    """The last batch's row of each key, with the batch's number."""
    return latest_rows(spark.read.parquet(path).withColumn(order, F.col(order).cast("long")), keys, order)


def compact(spark: SparkSession, path: str, keys: list[str], into: str, order: str = "batch_id") -> None:
    """The table as :func:`read_latest` has it, written to ``into`` by batch; later batches may go on there."""
    read_latest(spark, path, keys, order).write.mode("errorifexists").partitionBy(order).parquet(into)
