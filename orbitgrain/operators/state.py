"""Job state folded from attempts, in batch."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orbitgrain.functions.predicates import in_time_range
from orbitgrain.functions.scalars import json_or_text, quota_delay, retry_delay

STATE = "status string, attempts int, next_attempt_at timestamp, last_event bigint"
TERMINAL = ("completed", "failed", "retired")


def step(state: Column, event: Column, max_attempts: int, base: float, longest: float) -> Column:
    """The state after an event (event_id, ts, outcome, retry_after).

    Terminal states stay. An error waits by the back-off, throttling by what
    the server asked for; the last attempt ends as failed or retired.
    """
    attempts = state["attempts"] + 1
    last = attempts >= max_attempts
    throttled = event["outcome"] == "throttled"
    bad = event["outcome"].isin("error", "throttled")
    delay = F.when(throttled, quota_delay(event["retry_after"])).otherwise(retry_delay(state["attempts"], base, longest))
    status = F.when(event["outcome"] == "completed", "completed").when(bad & last, F.when(throttled, "retired").otherwise("failed")).when(bad, "retry_wait").otherwise("queued")
    due = F.when(bad & ~last, F.timestamp_micros(F.unix_micros(event["ts"]) + (delay * 1_000_000).cast("long")))
    moved = F.struct(status.alias("status"), F.when(bad, attempts).otherwise(state["attempts"]).alias("attempts"), due.alias("next_attempt_at"), event["event_id"].alias("last_event"))
    return F.when(state["status"].isin(*TERMINAL), state).otherwise(moved)


def fold_attempts(events: DataFrame, max_attempts: int = 5, base: float = 60.0, longest: float = 3600.0) -> DataFrame:
    """T04, T05 in batch: the state of each item after its attempts in order of event_id.

    Of an item's events only so many bad ones as attempts are allowed, its
    first success and its last neutral one can show in its state. The first
    are ranked with a limit that holds before the shuffle too, the others are
    combined, so an item with very many events brings few rows together.
    """
    from pyspark.sql import Window

    bad, done = F.coalesce(F.col("outcome"), F.lit("")).isin("error", "throttled"), F.coalesce(F.col("outcome"), F.lit("")) == "completed"
    event = F.struct("event_id", "ts", "outcome", "retry_after")
    first = Window.partitionBy("item_id").orderBy("event_id")
    failures = events.filter(bad).withColumn("_nth", F.row_number().over(first)).filter(F.col("_nth") <= max_attempts).select("item_id", event.alias("e"))
    others = events.filter(~bad).groupBy("item_id").agg(F.array_compact(F.array(F.min(F.when(done, event)), F.max(F.when(~done, event)))).alias("e")).select("item_id", F.explode("e").alias("e"))
    rows = failures.unionByName(others).groupBy("item_id").agg(F.array_sort(F.collect_list("e")).alias("e"))
    start = F.struct(F.lit("queued").alias("status"), F.lit(0).alias("attempts"), F.lit(None).cast("timestamp").alias("next_attempt_at"), F.lit(None).cast("bigint").alias("last_event"))
    final = F.aggregate("e", start, lambda s, e: step(s, e, max_attempts, base, longest))
    return rows.select("item_id", final.alias("s")).select("item_id", "s.*")


def due_jobs(jobs: DataFrame, now, limit: int, start=None, end=None) -> DataFrame:
    """Queued, or waiting and due; earliest first."""
    due = (F.col("status") == "queued") | ((F.col("status") == "retry_wait") & (F.col("next_attempt_at") <= F.lit(now).cast("timestamp")))
    return jobs.filter(due & in_time_range("item_datetime", start, end, half_open=True)).orderBy("item_datetime", "item_id").limit(limit)


def status_counts(jobs: DataFrame, start=None, end=None, column: str = "item_datetime") -> DataFrame:
    """A17"""
    return jobs.filter(in_time_range(column, start, end, half_open=True)).groupBy("status").agg(F.count(F.lit(1)).alias("n"))


def next_retry(jobs: DataFrame, start=None, end=None, column: str = "item_datetime") -> DataFrame:
    """A18"""
    return jobs.filter((F.col("status") == "retry_wait") & in_time_range(column, start, end, half_open=True)).agg(F.min("next_attempt_at").alias("next_attempt_at"))


def high_water_mark(ingested: DataFrame, previous=None) -> DataFrame:
    """The greatest item time, never before ``previous``."""
    top = F.max("item_datetime")
    return ingested.agg((top if previous is None else F.greatest(top, F.lit(previous).cast("timestamp"))).alias("mark"), F.count_distinct("item_id").alias("items"))


def discovery_window(last_processed, now, overlap_hours: int = 72):
    """(start, end) of the next search; starts over from now without a mark."""
    from datetime import timedelta

    return (last_processed or now) - timedelta(hours=overlap_hours), now


def windowed_status(jobs: DataFrame, start: str, days: int = 1, column: str = "item_datetime") -> DataFrame:
    """Counts by fixed window from ``start`` and what the window has come to."""
    origin = F.lit(start).cast("timestamp")
    number = F.floor((F.unix_micros(column) - F.unix_micros(origin)) / (days * 86_400_000_000)).cast("int")
    s = F.col("status")
    out = jobs.filter(F.col(column) >= origin).groupBy(number.alias("window")).agg(
        *(F.count_if(s == k).alias(k) for k in ("queued", "processing", "retry_wait", "completed", "failed", "retired"))
    )
    active = F.col("queued") + F.col("processing") + F.col("retry_wait")
    return out.withColumn("state", F.when(active > 0, "active").when(F.col("retired") > 0, "complete_with_retired").otherwise("complete"))


def backfill_progress(windows: DataFrame, total: int) -> DataFrame:
    """One row: the cursor (windows finished without a gap from the first), windows done, the total."""
    done = F.col("state") != "active"
    first_open = F.min(F.when(~done, F.col("window")))
    return windows.agg(F.coalesce(first_open, F.lit(total)).alias("cursor"), F.count_if(done).alias("done"), F.lit(total).alias("total"))


def append_events(events: DataFrame, message: str, level: str = "INFO", run_id: int | None = None, details: dict[str, str] | None = None) -> DataFrame:
    """Rows (item_id, asset_key) as events; details, a name -> column mapping, as JSON."""
    extra = F.to_json(F.struct(*(F.col(c).alias(k) for k, c in sorted((details or {}).items())))) if details else F.lit(None).cast("string")
    return events.select(F.current_timestamp().alias("ts"), F.lit(level).alias("level"), F.lit(run_id).cast("long").alias("run_id"), "item_id", "asset_key", F.lit(message).alias("message"), extra.alias("details"))


def read_settings(settings: DataFrame, key: str | None = None) -> DataFrame:
    """JSON values decoded."""
    rows = settings if key is None else settings.filter(F.col("key") == key)
    return rows.select("key", json_or_text(F.col("value")).alias("value"))
