"""Jobs and assets: the stream equals its batch twin, replays change nothing, retries come due and ended jobs go."""

from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from orbitgrain.plans.views import view
from orbitgrain.streaming import ingest, jobs

EVENTS = "item_id long, event_id long, ts timestamp, asset_key string, kind string, retry_after double"
T0 = datetime(2024, 1, 1)


@pytest.fixture(scope="module", autouse=True)
def rocks(spark):
    own = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider", "spark.sql.shuffle.partitions": "2"}
    before = {k: spark.conf.get(k) for k in own}
    for k, v in own.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def at(minutes):
    return T0 + timedelta(minutes=minutes)


def run(spark, tmp_path, parts, **how):
    """All rows that a stream over the parts, one file each, gives, batch by batch."""
    src, out = str(tmp_path / "in"), []
    for p in parts:
        p.coalesce(1).write.mode("append").parquet(src)
    stream = ingest.stream_of(spark, src, parts[0].schema, files_per_batch=1)
    ingest.run_available(jobs.job_asset_states(stream, **how), str(tmp_path / "cp"), lambda b, i: out.append(b.collect()), "update")
    return out


def last(batches):
    """The last row of each job and asset."""
    return {(r.item_id, r.asset_key): (r.status, r.attempts, r.next_attempt_at) for rows in batches for r in rows}


def test_stream_equals_batch_and_replays_change_nothing(spark, sf, tmp_path):
    events = view(spark, sf, "job_events_v")
    parts = events.withColumn("part", F.ntile(3).over(Window.orderBy("event_id"))).persist()
    split = [parts.filter(F.col("part") == k).drop("part") for k in (1, 2, 3)]
    again = split[1].unionByName(split[1].limit(20))  # repeated events in a batch, and a batch that comes twice
    got = run(spark, tmp_path, [split[0], again, split[1], split[2]], keep=None, late="3650 days")
    want = {(r.item_id, r.asset_key): (r.status, r.attempts, r.next_attempt_at) for r in jobs.fold_job_events(events).collect()}
    assert last(got) == want
    assert len({s for s, _, _ in want.values()}) >= 4
    assert [r for r in got[2] if not r.due] == []


def test_batch_twin_equals_the_rules(spark, sf):
    events = view(spark, sf, "job_events_v")
    state = {}
    for e in events.orderBy("event_id").collect():
        state.setdefault(e.item_id, jobs.Job()).take(e.event_id, 0, e.asset_key, e.kind, e.retry_after, 5, 60.0, 3600.0)
    want = {(i, None): (j.status, j.attempts) for i, j in state.items()} | {(i, k): v for i, j in state.items() for k, v in j.assets.items()}
    assert {(r.item_id, r.asset_key): (r.status, r.attempts) for r in jobs.fold_job_events(events).collect()} == want


def rows(spark, *events):
    return spark.createDataFrame([(i, n, at(m), k, kind, None) for n, (i, m, k, kind) in events], EVENTS)


def test_completed_only_when_all_assets_are(spark, tmp_path):
    first = rows(spark, *enumerate([(1, 0, "a", "asset"), (1, 0, "b", "asset"), (1, 1, None, "claim"), (1, 2, "a", "start"), (1, 3, "a", "completed"), (1, 3, "c", "completed")]))
    second = rows(spark, (6, (1, 4, "b", "start")), (7, (1, 5, None, "restart")), (8, (1, 6, "b", "completed")))
    third = rows(spark, (9, (1, 7, None, "claim")), (10, (1, 8, "b", "completed")))
    fourth = rows(spark, (11, (1, 9, "d", "asset")))
    got = [last([b]) for b in run(spark, tmp_path, [first, second, third, fourth], keep=None, late="3650 days") if b]
    assert got[0] == {(1, None): ("processing", 0, None), (1, "a"): ("completed", 0, None), (1, "b"): ("queued", 0, None)}
    assert got[1] == {(1, None): ("queued", 0, None)}  # the restart put b back, and what came for a queued job does not count
    assert got[2] == {(1, None): ("completed", 0, None), (1, "b"): ("completed", 0, None)}
    assert got[3] == {(1, None): ("queued", 0, None), (1, "d"): ("queued", 0, None)}


def test_waiting_jobs_come_up_by_event_time(spark, tmp_path):
    start = [(0, (1, 0, "a", "asset")), (1, (1, 1, None, "claim")), (2, (1, 2, "a", "error"))]
    others = [rows(spark, (10 + m, (2, m, None, "claim"))) for m in (2, 30, 60)]
    got = run(spark, tmp_path, [rows(spark, *start), *others], late="1 minute", keep="1 day")
    due = [r for b in got for r in b if r.due]
    assert [(r.item_id, r.status, r.attempts, r.next_attempt_at) for r in due] == [(1, "retry_wait", 1, at(3))]


def test_waiting_jobs_come_up_without_any_event(spark, tmp_path):
    start = [(0, (1, 0, "a", "asset")), (1, (1, 1, None, "claim")), (2, (1, 2, "a", "error")), (3, (2, 0, "a", "asset")), (4, (2, 0, None, "claim"))]
    src, cp = str(tmp_path / "in"), str(tmp_path / "cp")
    rows(spark, *start).coalesce(1).write.parquet(src)
    out = []
    states = jobs.job_asset_states(ingest.stream_of(spark, src, EVENTS), keep=None, clock="ProcessingTime")
    query = states.writeStream.outputMode("update").option("checkpointLocation", cp).foreachBatch(lambda b, i: out.extend(b.collect())).start()
    try:
        for _ in range(90):
            if any(r.due for r in out):
                break
            query.awaitTermination(1)
    finally:
        query.stop()
    assert [r.item_id for r in out if r.due] == [1]  # its time was long ago by this machine's clock


def test_a_claimed_job_has_no_timer_left_and_ended_jobs_are_cleared(spark, tmp_path):
    start = [(0, (1, 0, "a", "asset")), (1, (1, 1, None, "claim")), (2, (1, 2, "a", "error")), (3, (1, 2, None, "claim")), (4, (1, 3, "a", "completed"))]
    others = [rows(spark, (10 + m, (2, m, None, "claim"))) for m in (30, 60)]
    later = [rows(spark, (90, (2, 2000, None, "claim"))), rows(spark, (91, (2, 2001, None, "claim"))), rows(spark, (92, (1, 2002, "b", "asset")))]
    got = run(spark, tmp_path, [rows(spark, *start), *others, *later], late="1 minute", keep="1 day")
    flat = [r for b in got for r in b]
    assert not any(r.due for r in flat)
    # after a day the job was forgotten: the new asset starts another, without attempts
    assert [(r.asset_key, r.status, r.attempts) for r in flat if r.item_id == 1 and r.last_event == 92] == [(None, "queued", 0), ("b", "queued", 0)]


def test_retired_and_failed_jobs_stay(spark):
    rule = (2, 60.0, 3600.0)
    for kind, end, asset in (("error", "failed", "retry_wait"), ("throttled", "retired", "retired")):
        job = jobs.Job()
        for n, (key, what) in enumerate([("a", "asset"), (None, "claim"), ("a", kind), (None, "claim"), ("a", kind), (None, "claim"), ("z", "asset"), ("a", "completed"), (None, None)]):
            assert job.take(n, n, key, what, None, *rule)
            assert not job.take(n, n, key, what, None, *rule)
        assert (job.status, job.attempts, job.next_us, job.assets) == (end, 2, None, {"a": (asset, 2)})


def test_no_events(spark):
    assert jobs.fold_job_events(rows(spark, (0, (1, 0, "a", "asset"))).limit(0)).count() == 0
    odd = rows(spark, (0, (None, 0, "a", "asset")), (1, (3, 0, None, "asset")), (2, (3, 0, "a", "unknown")))
    assert sorted(((r.item_id, r.asset_key, r.status, r.last_event) for r in jobs.fold_job_events(odd).collect()), key=str) == [(3, None, "queued", 2), (None, "a", "queued", 0), (None, None, "queued", 0)]
