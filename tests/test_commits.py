"""Progress that outlives a run: nothing is lost, done twice or rewritten without need, wherever a run stops."""

from __future__ import annotations

import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from orbitgrain.streaming import commits, ingest

D = datetime(2024, 1, 1)


def files(path):
    return {os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def take_new(old, new):
    return old.join(new.select("k"), "k", "left_anti").unionByName(new)


def test_table_rewrites_touched_buckets_only(spark, tmp_path):
    t = commits.KeyedTable(spark, str(tmp_path), "k long, x string", "k", buckets=8)
    assert t.read().count() == 0
    assert t.apply(spark.createDataFrame([(i, "a") for i in range(100)], "k long, x string"), 0, take_new)
    before = files(t.table)
    assert t.apply(spark.createDataFrame([(7, "b")], "k long, x string"), 1, take_new)
    after, rewritten = files(t.table), lambda a, b: {os.path.basename(os.path.dirname(f)) for f in a - b}
    assert len(rewritten(before, after)) == len(rewritten(after, before)) == 1
    assert {(r.k, r.x) for r in t.read().collect()} == {(i, "b" if i == 7 else "a") for i in range(100)}
    assert not t.apply(spark.createDataFrame([(7, "c")], "k long, x string"), 1, take_new) and files(t.table) == after
    assert t.apply(spark.createDataFrame([], "k long, x string"), 2, take_new) and files(t.table) == after


@pytest.mark.parametrize("stop", ["before", "staged", "overwritten"])
def test_table_goes_on_wherever_a_batch_stopped(spark, tmp_path, stop):
    """Counting up is wrong if a batch is merged twice or not at all."""
    t = commits.KeyedTable(spark, str(tmp_path), "k long, n long", "k", buckets=4)

    def add(old, new):
        return old.unionByName(new).groupBy("k").agg(F.sum("n").alias("n"))

    rows = spark.createDataFrame([(i, 1) for i in range(20)], "k long, n long")
    t.apply(rows, 0, add)
    append, seen = t.log.append, []

    def broken(records):
        seen.append(records[0][1])
        if (stop, records[0][1]) in (("before", "staged"), ("overwritten", "applied")):
            raise RuntimeError("lost")
        append(records)
        if stop == records[0][1] == "staged":
            raise RuntimeError("lost")

    t.log.append = broken
    with pytest.raises(RuntimeError):
        t.apply(rows, 1, add)
    t.log.append = append
    assert t.apply(rows, 1, add) and not t.apply(rows, 1, add)
    assert {(r.k, r.n) for r in t.read().collect()} == {(i, 2) for i in range(20)}


SEEN = "item_id long, item_datetime timestamp, asset_key string, href string, local_path string, requested_assets array<string>, missing_assets array<string>"


def test_changed_sources_on_a_stream(spark, tmp_path):
    assets, jobs = (commits.KeyedTable(spark, str(tmp_path / n), s, "item_id", 4) for n, s in (("assets", commits.ASSETS), ("jobs", commits.JOBS)))
    step = commits.requeue_changed(assets, jobs)
    row = lambda i, key="a", href="h", asked="a": (i, D, key, href, "p", [asked], [])
    step(spark.createDataFrame([row(i) for i in range(1, 7)], SEEN), 0)
    for t in (assets, jobs):
        t.apply(t.read().select("item_id"), 1, lambda old, new: old.withColumn("status", F.lit("completed")).withColumn("attempts", F.lit(2)))
    batches = [[row(1), row(2, href="other"), row(3, asked="b"), row(4, key="b")], [row(2, href="other"), row(9), (None, D, "a", "h", "p", [], [])]]
    src = str(tmp_path / "in")
    for b in batches:
        spark.createDataFrame(b, SEEN).coalesce(1).write.mode("append").parquet(src)
    ingest.run_available(ingest.stream_of(spark, src, SEEN, files_per_batch=1), str(tmp_path / "cp"), lambda b, i: (step(b, i + 2), step(b, i + 2)))
    got = {r.item_id: (r.status, r.attempts) for r in jobs.read().collect()}
    assert got == {1: ("completed", 2), 2: ("queued", 2), 3: ("queued", 0), 4: ("queued", 2), 5: ("completed", 2), 6: ("completed", 2), 9: ("queued", 0)}
    own = {(r.item_id, r.asset_key): r.status for r in assets.read().collect()}
    assert own[2, "a"] == own[4, "b"] == own[9, "a"] == "queued" and own[4, "a"] == own[1, "a"] == "completed"


def test_jobs_settled_but_assets_lost(spark, tmp_path):
    assets, jobs = (commits.KeyedTable(spark, str(tmp_path / n), s, "item_id", 4) for n, s in (("assets", commits.ASSETS), ("jobs", commits.JOBS)))
    step = commits.requeue_changed(assets, jobs)
    step(spark.createDataFrame([(1, D, "a", "h", "p", ["a"], [])], SEEN), 0)
    apply = assets.apply
    assets.apply = lambda *a: (_ for _ in ()).throw(RuntimeError("lost"))
    moved = spark.createDataFrame([(1, D, "a", "h2", "p", ["a"], [])], SEEN)
    with pytest.raises(RuntimeError):
        step(moved, 1)
    assets.apply = apply
    step(moved, 1)
    assert [r.href for r in assets.read().collect()] == ["h2"] and [r.status for r in jobs.read().collect()] == ["queued"]


def test_a_batch_of_sources_is_worked_out_once(spark, tmp_path):
    assets, jobs = (commits.KeyedTable(spark, str(tmp_path / n), s, "item_id", 4) for n, s in (("assets", commits.ASSETS), ("jobs", commits.JOBS)))
    step, made = commits.requeue_changed(assets, jobs), spark.sparkContext.accumulator(0)

    def seen(parts):
        for part in parts:
            made.add(part.num_rows)
            yield part

    batch = spark.createDataFrame([(i, D, "a", "h", "p", ["a"], []) for i in range(50)], SEEN).mapInArrow(seen, SEEN)
    for _ in range(2):
        step(batch, 0)
    assert made.value == 50 and jobs.read().count() == assets.read().count() == 50


def test_a_large_bucket_is_written_by_several_tasks(spark, tmp_path):
    t = commits.KeyedTable(spark, str(tmp_path), "k long, x string", "k", buckets=1)
    size = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    try:
        t.apply(spark.range(40_000).select(F.col("id").alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("x")).repartition(4), 0, take_new)
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", size)
    assert len(files(t.table)) > 1 and t.read().distinct().count() == 40_000


def test_backfill_goes_on_behind_the_log(spark, tmp_path):
    plan, done = (spark, str(tmp_path / "log"), D, datetime(2024, 1, 5), 1), []

    def process(a, b):
        if a == datetime(2024, 1, 3) and len(done) == 2:
            raise RuntimeError("lost")
        done.append(a.day)
        return a != datetime(2024, 1, 4) or len(done) > 5

    with pytest.raises(RuntimeError):
        commits.Backfill(*plan).run(process)
    assert commits.Backfill(*plan).cursor() == datetime(2024, 1, 3)
    done.append(0)
    assert commits.Backfill(*plan).run(process) == datetime(2024, 1, 4)  # the last window has active jobs
    assert commits.Backfill(*plan).run(process) == datetime(2024, 1, 5) and done == [1, 2, 0, 3, 4, 4]
    with pytest.raises(ValueError):
        commits.Backfill(spark, plan[1], datetime(2024, 1, 2), plan[3])
    longer = commits.Backfill(spark, plan[1], D, datetime(2024, 1, 7))
    assert longer.cursor() == datetime(2024, 1, 5) and longer.run(lambda a, b: True) == datetime(2024, 1, 7)


def test_tiles_after_a_stop_between_write_and_commit(spark, tmp_path):
    source = spark.createDataFrame([(i % 4, i) for i in range(40)], "tile_id long, x long")
    log, out = commits.CommitLog(spark, str(tmp_path / "log"), "tile_id long, at timestamp"), str(tmp_path / "out")
    opened = spark.sparkContext.accumulator(0)

    def total(s):
        s.foreach(lambda _: opened.add(1))
        return s.groupBy("tile_id").agg(F.sum("x").alias("x"))

    commits.resume_tiles(source.filter("tile_id = 0"), log, out, total)
    append, log.append = log.append, lambda rows: (_ for _ in ()).throw(RuntimeError("lost"))
    with pytest.raises(RuntimeError):
        commits.resume_tiles(source.filter("tile_id < 3"), log, out, total)
    log.append = append
    opened.value = 0
    want = {(r.tile_id, r.x) for r in source.groupBy("tile_id").agg(F.sum("x").alias("x")).collect()}
    assert {(r.tile_id, r.x) for r in commits.resume_tiles(source, log, out, total).collect()} == want
    assert opened.value == 30  # tile 0 was not opened again
    opened.value = 0
    assert {(r.tile_id, r.x) for r in commits.resume_tiles(source, log, out, total).collect()} == want and opened.value == 0
    assert {(r.tile_id, r.x) for r in commits.resume_tiles(source, log, out, total, overwrite=True).collect()} == want and opened.value == 40
