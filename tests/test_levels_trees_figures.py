"""Boxes of any size, inventories by hash tree, figures of streams."""

from __future__ import annotations

import random
import time
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from orbitgrain.operators import audit, grid, inventories, state
from orbitgrain.streaming import ingest, observed

BOX = "west double, south double, east double, north double"


def test_boxes_of_any_size(spark):
    rng = random.Random(4)

    def boxes(n):
        out = []
        for i in range(n):
            w, h = (2 ** rng.uniform(-2, 14) for _ in range(2))
            x, y = rng.uniform(-9000, 9000), rng.uniform(-9000, 9000)
            out.append((i, x, y, x + w, y + h))
        return [*out, (n, 0.0, 0.0, 0.0, 0.0), (n + 1, None, 0.0, 1.0, 1.0), (n + 2, 16.0, 16.0, 32.0, 32.0)]

    a, b = boxes(150), boxes(200)
    r, f = spark.createDataFrame(a, f"region_id long, {BOX}"), spark.createDataFrame(b, f"item_id long, {BOX}")
    want = sorted((i, j) for i, *p in a for j, *q in b if None not in (*p, *q) and p[0] <= q[2] and q[0] <= p[2] and p[1] <= q[3] and q[1] <= p[3])
    got = grid.spatial_join_levels(r, f, 1.0)
    assert sorted(map(tuple, got.collect())) == want
    assert sorted(map(tuple, grid.spatial_join_levels(r, f, 1.0, levels=3).filter("region_id < 20").collect())) == [p for p in want if p[0] < 20]
    assert grid.spatial_join_levels(r.limit(0), f, 1.0).count() == 0


def test_totals_of_many_copies_of_a_box(spark):
    """Six billion pairs, of nine classes of boxes."""
    at = lambda k, w: ((F.col("id") % 3 * k).cast("double").alias("west"), F.lit(0.0).alias("south"), (F.col("id") % 3 * k + w).cast("double").alias("east"), F.lit(float(w)).alias("north"))
    r, f = spark.range(30_000).select(F.col("id").alias("region_id"), *at(10, 5)), spark.range(300_000).select(F.col("id").alias("item_id"), *at(7, 4))
    of = {j: (100_000, sum(range(j, 300_000, 3))) for j in range(3)}
    want = {i: tuple(map(sum, zip(*(of[j] for j in range(3) if 7 * j <= 10 * i + 5 and 10 * i <= 7 * j + 4), strict=True))) for i in range(3)}
    for join in (grid.spatial_join, grid.spatial_join_levels):
        got = grid.spatial_totals(r, f, 2.0, join).collect()
        assert len(got) == 20_000 and not want[2]  # the third class meets nothing
        assert all((x.n, x.ids) == want[x.region_id % 3] for x in got)


def files(changed=()):
    rows = []
    for m in range(1, 7):
        for d in (1, 15):
            for p in "ab":
                for k in range(5):
                    path = f"{m}/{d}/{p}/{k}"
                    rows.append((f"2024-{m:02}", f"{d:02}", p, path, 9 if path in changed else 5, "h"))
    return rows


COLUMNS = "month string, day string, product string, path string, size long, sha256 string"


def test_tree_reads_and_joins_what_differs(spark, tmp_path):
    a = [*files(), ("2024-07", "01", "a", "gone", 1, None)]
    b = [*files({"3/15/b/2"}), ("2024-03", "15", "b", "new", 1, "h")]
    for name, rows in (("a", a), ("b", b)):
        inventories.write_inventory(spark.createDataFrame(rows, COLUMNS).repartition(3), str(tmp_path / name))
    got = inventories.reconcile_inventories(spark, str(tmp_path / "a"), str(tmp_path / "b"))
    full = audit.reconcile(spark.createDataFrame(a, COLUMNS), spark.createDataFrame(b, COLUMNS), ("month", "day", "product", "path")).filter("class <> 'ok'")
    assert sorted(map(tuple, got.filter("class <> 'ok'").collect())) == sorted(map(tuple, full.collect()))
    assert {(r.month, r.day, r.product) for r in got.collect()} == {("2024-03", "15", "b"), ("2024-07", "01", "a")}
    text = got._jdf.queryExecution().optimizedPlan().toString()
    assert "2024-03" in text and "2024-04" not in text  # folders are named to the scan, unchanged months are not among them
    same = inventories.reconcile_inventories(spark, str(tmp_path / "a"), str(tmp_path / "a"))
    assert same.count() == 0


def test_inventory_files_do_not_follow_the_days(spark, tmp_path):
    """Two hundred days of few files are written to few files, and a day of very many to several."""
    day = F.when(F.col("id") % 2 == 0, 7).otherwise(F.col("id") % 200)
    rows = spark.range(20_000).select(F.format_string("2024-%02d", (day / 28 + 1).cast("int")).alias("month"), F.format_string("%02d", (day % 28 + 1).cast("int")).alias("day"), F.lit("p").alias("product"), F.col("id").cast("string").alias("path"), F.lit(1).alias("size"), F.lit("h").alias("sha256"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        inventories.write_inventory(rows, str(tmp_path))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    back = spark.read.schema(inventories.FILES).parquet(str(tmp_path / "files"))
    assert sorted(map(tuple, back.select(rows.columns).collect())) == sorted(map(tuple, rows.collect()))
    assert len(list((tmp_path / "files").rglob("*.parquet"))) <= 8 + 8
    assert back.filter("month = '2024-01' and day = '08'").select(F.input_file_name()).distinct().count() > 1


def test_tree_does_not_depend_on_order_and_counts_repeats(spark):
    rows = spark.createDataFrame(files(), COLUMNS)
    one, two = (inventories.hash_tree(x) for x in (rows, rows.orderBy(F.rand(1)).repartition(4)))
    assert inventories.differing(one, two, "product").count() == inventories.differing(one, two, "month").count() == 0
    more = inventories.hash_tree(rows.unionByName(rows.limit(1)))
    assert [inventories.differing(one, more, x).count() for x in inventories.LEVELS] == [1, 1, 1]
    assert one.filter("level = 'month'").count() == 6 and inventories.hash_tree(rows.limit(0)).count() == 0


def test_figures_of_a_stream_equal_the_batch_queries(spark, tmp_path):
    src, rows = str(tmp_path / "in"), []
    for k in range(3):
        part = [(10 * k + i, datetime(2024, 1, 1) + timedelta(hours=(7 * (10 * k + i)) % 50), observed.STATUSES[(i + k) % 6]) for i in range(10)]
        rows += part
        spark.createDataFrame(part, "item_id long, item_datetime timestamp, status string").coalesce(1).write.mode("append").parquet(src)
    figures = observed.Figures("jobs")
    spark.streams.addListener(figures)
    try:
        stream = observed.with_figures(ingest.stream_of(spark, src, "item_id long, item_datetime timestamp, status string", files_per_batch=1), "jobs", "item_datetime", "status")
        ingest.run_available(stream, str(tmp_path / "cp"), lambda b, _: b.write.format("noop").mode("overwrite").save())
        for _ in range(50):
            if figures.totals().get("rows") == 30:
                break
            time.sleep(0.2)
    finally:
        spark.streams.removeListener(figures)
    table = spark.read.parquet(src)
    mark = state.high_water_mark(table).select(F.unix_micros("mark")).first()[0]
    want = {r.status: r.n for r in state.status_counts(table).collect()}
    got = figures.totals()
    assert figures.mark_us == mark and got.pop("rows") == 30 and {k: n for k, n in got.items() if n} == want
    assert len(figures.batches) == 3 and observed.Figures("x", 5).mark_us == 5
