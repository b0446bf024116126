"""Jobs and their assets as keyed state with timers.

A job is an item; its assets are what has to be fetched for it. Events are
rows (item_id, event_id, ts, asset_key, kind, retry_after):

``asset``       registers an asset; a completed job is queued again by one it does not know
``claim``       a queued or waiting job is processed from now on
``restart``     what is processed, job or asset, is queued again
``start``       an asset is being fetched
``completed``   an asset is there; the job is complete once all of its assets are
``interrupted`` asset and job are queued again, no attempt is counted
``error``       asset and job wait by the back-off, or the job has failed
``throttled``   they wait as long as the server asks, or both are retired

The last five count only while the job is processed and the asset is known.
A failed or retired job stays as it is. Null and unknown kinds and keys change
nothing. Events of an item come in order of event_id from batch to batch; one
that is not after the last one is a replay and changes nothing.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from orbitgrain.functions.scalars import quota_delay, retry_delay

OUT = "item_id long, asset_key string, status string, attempts int, next_attempt_at timestamp, last_event long, due boolean"
ASSET_KINDS = ("start", "completed", "interrupted", "error", "throttled")
ENDED = ("completed", "failed", "retired")


class Job:
    """One job's state: status, attempts, next attempt in microseconds, last event, and {asset: (status, attempts)}."""

    def __init__(self, status: str = "queued", attempts: int = 0, next_us: int | None = None, last: int | None = None, assets: dict[str, tuple[str, int]] | None = None):
        self.status, self.attempts, self.next_us, self.last, self.assets = status, attempts, next_us, last, assets or {}

    def take(self, event_id: int, ts_us: int, key: str | None, kind: str | None, retry_after: float | None, max_attempts: int, base: float, longest: float) -> bool:
        """Apply an event and say whether it was new."""
        if self.last is not None and event_id <= self.last:
            return False
        self.last = event_id
        if self.status in ("failed", "retired"):
            return True
        if kind == "asset" and key is not None and key not in self.assets:
            self.assets[key] = ("queued", 0)
            self.status = "queued" if self.status == "completed" else self.status
        elif kind == "claim" and self.status in ("queued", "retry_wait"):
            self.status, self.next_us = "processing", None
        elif kind == "restart" and self.status == "processing":
            self.status = "queued"
            self.assets = {k: ("queued" if s == "processing" else s, n) for k, (s, n) in self.assets.items()}
        elif kind in ASSET_KINDS and self.status == "processing" and key in self.assets:
            self._asset(ts_us, key, kind, retry_after, max_attempts, base, longest)
        return True

    def _asset(self, ts_us, key, kind, retry_after, max_attempts, base, longest) -> None:
        status, tried = self.assets[key]
        if kind == "start":
            self.assets[key] = ("completed" if status == "completed" else "processing", tried)
        elif kind == "completed":
            self.assets[key] = ("completed", tried)
            if all(s == "completed" for s, _ in self.assets.values()):
                self.status, self.next_us = "completed", None
        elif kind == "interrupted":
            self.assets[key] = ("queued", tried)
            self.status, self.next_us = "queued", None
        else:
            throttled = kind == "throttled"
            wait = (900.0 if retry_after is None else float(retry_after)) if throttled else min(longest, base * 2.0 ** min(self.attempts, 60))
            self.attempts += 1
            over = self.attempts >= max_attempts
            self.assets[key] = ("retired" if over and throttled else "retry_wait", tried + 1)
            self.status = ("retired" if throttled else "failed") if over else "retry_wait"
            self.next_us = None if over else ts_us + int(wait * 1_000_000)

    def rows(self, item_id: int, changed: Iterable[str] = (), due: bool = False) -> Iterator[tuple]:
        yield item_id, None, self.status, self.attempts, self.next_us, self.last, due
        for k in sorted(changed):
            yield item_id, k, *self.assets[k], None, self.last, False


def frame(rows: Iterable[tuple]) -> pd.DataFrame:
    df = pd.DataFrame(list(rows), columns=["item_id", "asset_key", "status", "attempts", "next_attempt_at", "last_event", "due"])
    df["next_attempt_at"] = pd.to_datetime(pd.array(df["next_attempt_at"].tolist(), "Int64"), unit="us")
    return df.astype({"attempts": "int32", "last_event": "Int64"})


class JobStates(StatefulProcessor):
    """Keeps a job and a map of its assets; timers bring up retries that are due and clear jobs that have ended.

    With a null ``keep_us`` ended jobs stay for good.
    """

    def __init__(self, max_attempts: int, base: float, longest: float, keep_us: int | None):
        self.rule, self.keep_us = (max_attempts, base, longest), keep_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.job = handle.getValueState("job", "status string, attempts int, next_us long, last long, timer_ms long")
        self.assets = handle.getMapState("assets", "asset_key string", "status string, attempts int")

    def _load(self) -> tuple[Job, int | None]:
        if not self.job.exists():
            return Job(), None
        status, attempts, next_us, last, timer = (None if x is None or x != x else x for x in self.job.get())
        return Job(status, int(attempts), next_us, last, {k[0]: (v[0], int(v[1])) for k, v in self.assets.iterator()} if self.assets.exists() else {}), timer

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        job, timer = self._load()
        before, new, at = dict(job.assets), False, None
        events = pd.concat(list(rows)).sort_values("event_id", kind="stable")
        for e in events.itertuples(index=False):
            ts_us = e.ts.value // 1000
            if job.take(int(e.event_id), ts_us, None if pd.isna(e.asset_key) else e.asset_key, e.kind, None if pd.isna(e.retry_after) else e.retry_after, *self.rule):
                new, at = True, ts_us
        if not new:
            return
        changed = [k for k, v in job.assets.items() if before.get(k) != v]
        for k in changed:
            self.assets.updateValue((k,), job.assets[k])
        # one timer at a time: the next attempt, or the end of a job that is over
        wanted = job.next_us if job.next_us is not None else at + self.keep_us if job.status in ENDED and self.keep_us is not None else None
        wanted = None if wanted is None else -(-wanted // 1000)
        if timer != wanted:
            if timer is not None:
                self.handle.deleteTimer(timer)
            if wanted is not None:
                self.handle.registerTimer(wanted)
        self.job.update((job.status, job.attempts, job.next_us, job.last, wanted))
        yield frame(job.rows(key[0], changed))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        job, timer = self._load()
        if timer != expiredTimerInfo.getExpiryTimeInMs():
            return
        if job.status == "retry_wait":
            self.job.update((job.status, job.attempts, job.next_us, job.last, None))
            yield frame(job.rows(key[0], due=True))
        elif job.status in ENDED:
            self.job.clear()
            self.assets.clear()

    def close(self) -> None:
        pass


def job_asset_states(events: DataFrame, max_attempts: int = 5, base: float = 60.0, longest: float = 3600.0, keep: str | None = "30 days", late: str = "72 hours", clock: str = "EventTime") -> DataFrame:
    """A stream of events to what each batch changes: a row for a job (asset_key null) and one for each asset that moved.

    A waiting job comes up by itself, as a row with ``due``, once its next
    attempt's time has come: by the events' own time (``EventTime``: the
    watermark, ``late`` behind) or the machine's (``ProcessingTime``; such a
    query goes on with batches for its timers, so run it until it is stopped). Jobs
    that have ended are cleared ``keep`` after their last event; an event that
    comes later still starts a job anew, so ``keep`` is longer than events are
    late. Needs the RocksDB state store. A null item_id is a job of its own;
    events without event_id or ts are left out.
    """
    width = events.sparkSession.range(1).select(F.expr(f"unix_micros(timestamp'1970-01-01 00:00:00' + interval {keep}) - unix_micros(timestamp'1970-01-01 00:00:00')")).first()[0] if keep else None
    rows = events.select(F.col("item_id").cast("long").alias("item_id"), F.col("event_id").cast("long").alias("event_id"), F.col("ts").cast("timestamp").alias("ts"), "asset_key", "kind", F.col("retry_after").cast("double").alias("retry_after"))
    rows = rows.filter("event_id is not null and ts is not null")
    if clock == "EventTime":
        rows = rows.withWatermark("ts", late)
    return rows.groupBy("item_id").transformWithStateInPandas(JobStates(max_attempts, base, longest, width), OUT, "Update", clock)


def _merged(assets: Column, key: Column, status: Column, attempts: Column) -> Column:
    one = F.create_map(key, F.struct(status.alias("status"), attempts.cast("int").alias("attempts")))
    return F.map_concat(F.map_filter(assets, lambda k, _: k != key), one)


def _step(s: Column, e: Column, max_attempts: int, base: float, longest: float) -> Column:
    """The rules above as a column: the state after an event."""
    key, kind, status, assets = e["asset_key"], F.coalesce(e["kind"], F.lit("")), s["status"], s["assets"]
    known = key.isNotNull() & F.coalesce(F.map_contains_key(assets, F.coalesce(key, F.lit(""))), F.lit(False))
    own = assets[F.coalesce(key, F.lit(""))]
    hit = (status == "processing") & known
    bad, throttled = kind.isin("error", "throttled"), kind == "throttled"
    attempts = s["attempts"] + 1
    over = attempts >= max_attempts
    delay = F.when(throttled, quota_delay(e["retry_after"])).otherwise(retry_delay(s["attempts"], base, longest))
    due = F.timestamp_micros(F.unix_micros(e["ts"]) + (delay * 1_000_000).cast("long"))
    done = _merged(assets, key, F.lit("completed"), own["attempts"])
    all_done = F.forall(F.map_values(done), lambda a: a["status"] == "completed")

    def state(status=status, attempts=s["attempts"], next_=s["next_attempt_at"], assets=assets):
        return F.struct(status.alias("status"), attempts.cast("int").alias("attempts"), next_.alias("next_attempt_at"), e["event_id"].alias("last_event"), assets.alias("assets"))

    null = F.lit(None).cast("timestamp")
    registered = state(status=F.when(status == "completed", "queued").otherwise(status), assets=_merged(assets, key, F.lit("queued"), F.lit(0)))
    restarted = state(status=F.lit("queued"), assets=F.transform_values(assets, lambda _, a: F.struct(F.when(a["status"] == "processing", "queued").otherwise(a["status"]).alias("status"), a["attempts"].alias("attempts"))))
    failed = state(
        F.when(over, F.when(throttled, "retired").otherwise("failed")).otherwise("retry_wait"), attempts, F.when(~over, due),
        _merged(assets, key, F.when(over & throttled, "retired").otherwise("retry_wait"), own["attempts"] + 1),
    )
    return (
        F.when(status.isin("failed", "retired"), state())
        .when((kind == "asset") & key.isNotNull() & ~known, registered)
        .when((kind == "claim") & status.isin("queued", "retry_wait"), state(status=F.lit("processing"), next_=null))
        .when((kind == "restart") & (status == "processing"), restarted)
        .when(hit & (kind == "start"), state(assets=_merged(assets, key, F.when(own["status"] == "completed", "completed").otherwise("processing"), own["attempts"])))
        .when(hit & (kind == "completed"), state(status=F.when(all_done, "completed").otherwise(status), next_=F.when(~all_done, s["next_attempt_at"]), assets=done))
        .when(hit & (kind == "interrupted"), state(status=F.lit("queued"), next_=null, assets=_merged(assets, key, F.lit("queued"), own["attempts"])))
        .when(hit & bad, failed)
        .otherwise(state())
    )


def fold_job_events(events: DataFrame, max_attempts: int = 5, base: float = 60.0, longest: float = 3600.0) -> DataFrame:
    """T04, T05 in batch: the state of each job and asset after all its events, one row each (asset_key null for the job).

    Of an item's repeated events with one event_id one counts. An item's
    events meet in one row, as they do in a stream; they are five short
    columns, and what an item has no use for by its kind or key is left out
    first.
    """
    useful = F.col("kind").isin("claim", "restart") | (F.col("kind").isin("asset", *ASSET_KINDS) & F.col("asset_key").isNotNull())
    last = events.groupBy("item_id").agg(
        F.max("event_id").alias("last_event"), F.array_sort(F.collect_set(F.when(useful, F.struct("event_id", "ts", "asset_key", "kind", "retry_after")))).alias("e")
    )
    start = F.struct(
        F.lit("queued").alias("status"), F.lit(0).alias("attempts"), F.lit(None).cast("timestamp").alias("next_attempt_at"), F.lit(None).cast("long").alias("last_event"), F.expr("cast(map() as map<string,struct<status:string,attempts:int>>)").alias("assets")
    )
    folded = last.select("item_id", "last_event", F.aggregate("e", start, lambda s, e: F.when(s["last_event"] == e["event_id"], s).otherwise(_step(s, e, max_attempts, base, longest))).alias("s"))
    job = F.struct(F.lit(None).cast("string").alias("asset_key"), F.col("s.status").alias("status"), F.col("s.attempts").alias("attempts"), F.col("s.next_attempt_at").alias("next_attempt_at"))
    assets = F.transform(F.map_entries("s.assets"), lambda a: F.struct(a["key"].alias("asset_key"), a["value"]["status"].alias("status"), a["value"]["attempts"].alias("attempts"), F.lit(None).cast("timestamp").alias("next_attempt_at")))
    return folded.select("item_id", F.explode(F.concat(F.array(job), assets)).alias("r"), "last_event").select("item_id", "r.*", "last_event")


def due_retries(states: DataFrame, now: Column) -> DataFrame:
    """Jobs that wait and whose time has come by ``now``, earliest first."""
    return states.filter(F.col("asset_key").isNull() & (F.col("status") == "retry_wait") & (F.col("next_attempt_at") <= now)).orderBy("next_attempt_at", "item_id")
