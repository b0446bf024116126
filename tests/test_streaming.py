"""Streams equal their batch twins, and replays change nothing."""

from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from orbitgrain.operators import state
from orbitgrain.plans.views import view
from orbitgrain.streaming import ingest, windows


def brute(rows, max_attempts=5, base=60.0, longest=3600.0):
    out = {}
    for item, group in rows.groupby("item_id"):
        out[item] = ingest.advance(("queued", 0, None, None), group, max_attempts, base, longest)
    return out


@pytest.fixture(scope="module")
def attempts(spark, sf):
    return view(spark, sf, "attempts_v")


def test_batch_fold(attempts):
    want = brute(attempts.toPandas())
    got = {r.item_id: (r.status, r.attempts, None if r.next_attempt_at is None else r.us, r.last_event) for r in state.fold_attempts(attempts).withColumn("us", F.unix_micros("next_attempt_at")).collect()}
    assert got == want


def test_batch_fold_limits_rows_before_the_shuffle(spark, attempts):
    plan = state.fold_attempts(attempts)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2 and "partial_max" in plan
    hot = spark.range(20_000).select(F.lit(1).cast("long").alias("item_id"), F.col("id").alias("event_id"), F.timestamp_seconds("id").alias("ts"), F.when(F.col("id") % 9000 == 8999, "error").otherwise("queued").alias("outcome"), F.lit(None).cast("double").alias("retry_after"))
    row = state.fold_attempts(hot).first()
    assert (row.status, row.attempts, row.last_event) == ("queued", 2, 19_999)
    assert state.fold_attempts(hot, max_attempts=2).first()[1:3] == ("failed", 2) and state.fold_attempts(hot.limit(0)).count() == 0


def test_stream_equals_batch(spark, attempts, tmp_path):
    src = str(tmp_path / "in")
    for k in range(3):  # in order of event_id, as attempts arrive
        attempts.withColumn("part", F.ntile(3).over(Window.orderBy("event_id"))).filter(F.col("part") == k + 1).drop("part").coalesce(1).write.mode("append").parquet(src)
    stream = ingest.stream_of(spark, src, attempts.schema, files_per_batch=1)
    table = str(tmp_path / "jobs")
    each = ingest.keep_latest(table)
    seen = []

    def twice(batch, batch_id):
        each(batch, batch_id)
        if not seen:
            each(batch, batch_id)
        seen.append(batch_id)

    ingest.run_available(ingest.job_states(stream), str(tmp_path / "cp"), twice, "update")
    got = {r.item_id: (r.status, r.attempts) for r in ingest.read_latest(spark, table, ["item_id"]).collect()}
    want = {r.item_id: (r.status, r.attempts) for r in state.fold_attempts(attempts).collect()}
    assert got == want and len(seen) == 3
    ingest.compact(spark, table, ["item_id"], table + "-new")
    assert {r.item_id: (r.status, r.attempts) for r in ingest.read_latest(spark, table + "-new", ["item_id"]).collect()} == want


def test_new_items_once(spark, tmp_path):
    src = str(tmp_path / "in")
    rows = [(i % 5, datetime(2024, 1, 1) + timedelta(hours=i)) for i in range(20)]
    spark.createDataFrame(rows, "item_id long, acquired timestamp").repartition(2).write.parquet(src)
    got = []
    ingest.run_available(ingest.new_items(ingest.stream_of(spark, src, "item_id long, acquired timestamp")), str(tmp_path / "cp"), lambda b, _: got.extend(r.item_id for r in b.collect()))
    assert sorted(got) == [0, 1, 2, 3, 4]


def test_window_counts(spark, tmp_path):
    src = str(tmp_path / "in")
    spark.createDataFrame([(datetime(2024, 1, 1, 10), "queued"), (datetime(2024, 1, 2, 10), "queued"), (datetime(2024, 1, 2, 11), "failed")], "ts timestamp, status string").write.parquet(src)
    got = []
    ingest.run_available(windows.window_counts(ingest.stream_of(spark, src, "ts timestamp, status string")), str(tmp_path / "cp"), lambda b, _: got.extend((r.start.day, r.status, r.n) for r in b.collect()), "update")
    assert sorted(got) == [(1, "queued", 1), (2, "failed", 1), (2, "queued", 1)]


def test_backfill_resumes():

    plan = windows.backfill_windows(datetime(2024, 1, 1), datetime(2024, 1, 4, 12))
    assert len(plan) == 4 and plan[-1][1] == datetime(2024, 1, 4, 12)
    done = []
    cursor = windows.run_backfill(plan, None, lambda a, b: len(done) < 2 and not done.append(a))
    assert cursor == datetime(2024, 1, 3)
    assert windows.run_backfill(plan, cursor, lambda a, b: True) == plan[-1][1]
    with pytest.raises(ValueError):
        windows.run_backfill(plan, None, lambda a, b: True, start=datetime(2023, 1, 1))


def test_follow_without_what_the_bootstrap_left(spark, tmp_path):
    """The stream after the bootstrap takes nothing that the bootstrap has set aside, and each item once."""
    first = [(i, i % 3, datetime(2024, 1, 1) + timedelta(hours=i), 100.0) for i in range(12)]
    items = spark.createDataFrame(first, "item_id long, tile_id long, acquired timestamp, area double")
    chosen = items.groupBy("tile_id").agg(F.max(F.struct("acquired", "item_id")).alias("r")).select("tile_id", "r.item_id")
    ignored = str(tmp_path / "ignored")
    items.join(chosen, "item_id", "left_anti").select("item_id").write.parquet(ignored)
    src, got = str(tmp_path / "in"), []
    later = [(i, i % 3, datetime(2024, 1, 2) + timedelta(hours=i), 100.0) for i in (20, 21, 20)]
    spark.createDataFrame(first + later, items.schema).coalesce(1).write.parquet(src)
    stream = ingest.without_ignored(ingest.new_items(ingest.stream_of(spark, src, items.schema)), spark.read.parquet(ignored))
    ingest.run_available(stream, str(tmp_path / "cp"), lambda b, _: got.extend(r.item_id for r in b.collect()))
    assert sorted(got) == [9, 10, 11, 20, 21]
