"""Blocks against the same work on pixels."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from orbitgrain.operators import blocks, composite, grid

EDGE = "array<struct<x1:double,y1:double,x2:double,y2:double>>"


def as_blocks(spark, cells, width):
    """Blocks of {(x, y): v}; cells without a value are null."""
    rows = {}
    for (x, y), v in cells.items():
        rows.setdefault((x // width, y // width), [None] * width * width)[y % width * width + x % width] = v
    return spark.createDataFrame([(*k, v) for k, v in rows.items()], "bx int, by int, v array<double>")


def as_cells(rows, width):
    return {(r.bx * width + i % width, r.by * width + i // width): v for r in rows for i, v in enumerate(r.v) if v is not None and v == v}


def test_morton_ranges_hold_the_window_and_little_else(spark):
    rng = random.Random(3)
    pts = spark.range(0, 64 * 64).select((F.col("id") % 64 - 32).cast("int").alias("bx"), (F.floor(F.col("id") / 64) - 32).cast("int").alias("by"))
    place = {(r.bx, r.by): r.z for r in pts.select("bx", "by", blocks.morton(F.col("bx"), F.col("by")).alias("z")).collect()}
    assert len(set(place.values())) == 64 * 64
    for most in (1, 4, 32):
        for _ in range(20):
            x0, y0 = rng.randrange(-32, 32), rng.randrange(-32, 32)
            x1, y1 = rng.randrange(x0, 32), rng.randrange(y0, 32)
            ranges = blocks.morton_ranges(x0, y0, x1, y1, most)
            held = {p for p, z in place.items() if any(a <= z <= b for a, b in ranges)}
            window = {(x, y) for x in range(x0, x1 + 1) for y in range(y0, y1 + 1)}
            assert window <= held and len(ranges) <= most
            if most == 32:
                assert len(held) <= 2 * len(window) + 64
    assert blocks.morton_ranges(3, 0, 2, 5) == []
    assert spark.range(1).select(blocks.morton(F.lit(1 << 30), F.lit(0)).alias("z")).first().z is None


def test_window_reads_skip_row_groups(spark, tmp_path):
    width, n = 16, 48
    table = spark.range(n * n).select((F.col("id") % n).cast("int").alias("bx"), F.floor(F.col("id") / n).cast("int").alias("by"), F.transform(F.sequence(F.lit(0), F.lit(width * width - 1)), lambda i: F.xxhash64("id", i).cast("double")).alias("v"))
    path = str(tmp_path / "blocks")
    blocks.write_blocks(table, path, row_group_bytes=64 << 10)

    def scanned(df):
        df.count()
        found, plan = [], df._jdf.queryExecution().executedPlan()

        def walk(p):
            if "Scan" in p.nodeName():
                found.append(p.metrics().get("numOutputRows").get().value())
            for i in range(p.children().size()):
                walk(p.children().apply(i))

        df.collect()
        walk(plan.executedPlan() if hasattr(plan, "executedPlan") and "Adaptive" in plan.nodeName() else plan)
        return max(found)

    got = blocks.read_window(spark, path, 5, 7, 8, 10)
    assert {(r.bx, r.by) for r in got.select("bx", "by").collect()} == {(x, y) for x in range(5, 9) for y in range(7, 11)}
    want = table.filter("bx between 5 and 8 and by between 7 and 10")
    assert {(r.bx, r.by, tuple(r.v)) for r in got.collect()} == {(r.bx, r.by, tuple(r.v)) for r in want.collect()}
    plain = spark.read.parquet(path).filter("bx between 5 and 8 and by between 7 and 10")
    assert scanned(got) * 4 < n * n and scanned(got) <= scanned(plain)
    assert blocks.read_window(spark, path, 100, 0, 120, 5).count() == 0
    far = str(tmp_path / "far")
    blocks.write_blocks(spark.createDataFrame([(1 << 25, 0, [1.0]), (3, 3, [2.0])], "bx int, by int, v array<double>"), far)
    assert blocks.read_window(spark, far, 0, 0, 1 << 26, 5).count() == 2


@pytest.mark.parametrize("factor", [2, 3])
def test_resampling_equals_that_of_pixels(spark, factor):
    rng, width = random.Random(7), 4
    cells = {(x, y): rng.random() * 100 for x in range(-8, 12) for y in range(0, 12) if rng.random() < 0.8 and not (4 <= x < 8 and 4 <= y < 8)}
    table = as_blocks(spark, cells, width)
    source = spark.createDataFrame([(*k, v) for k, v in cells.items()], "cx long, cy long, v double")
    there = {(x // width, y // width) for x, y in cells}
    fine = [(x, y) for x in range(-8 * factor, 12 * factor) for y in range(12 * factor) if (x // factor // width, y // factor // width) in there]
    targets = spark.createDataFrame(fine, "cx long, cy long")
    for method, plain in (("bilinear", grid.bilinear), ("nearest", grid.nearest)):
        got = as_cells(blocks.resample_blocks(table, width, factor, "v", method).collect(), width * factor)
        want = {(r.cx, r.cy): r.v for r in plain(targets, source, 1.0, float(factor)).collect()}
        assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k]) for k in want)
    with pytest.raises(ValueError):
        blocks.resample_blocks(table, width, 0, "v")
    assert blocks.resample_blocks(table.limit(0), width, 2, "v").count() == 0


def test_halo_moves_edges_only(spark):
    width = 16
    table = as_blocks(spark, {(x, y): 1.0 for x in range(64) for y in range(64)}, width)
    sent = blocks._edges(table, [], "v", width)
    assert sent.agg(F.sum(F.size("cells"))).first()[0] == 16 * (4 * width + 4)
    halo = blocks.with_halo(table, width, "v")
    assert halo.count() == 16 and {len(r.halo) for r in halo.collect()} == {3, 5, 8}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_clipped_blocks_equal_clipped_pixels(spark, seed):
    rng, width, res = random.Random(seed), 3, 10.0
    cells = {(x, y): float(x * 1000 + y) for x in range(-16, 48) for y in range(-16, 48)}
    outer = [(-100.0, -90.0), (rng.uniform(100, 470), -150.0), (430.0, rng.uniform(100, 400)), (200.0, 455.0), (rng.uniform(-140, 0), 300.0), (-40.0, 80.0)]
    hole = [(120.0, 120.0), (220.0, 120.0), (220.0, 240.0), (120.0, 240.0)]
    edges = [(*a, *b) for ring in (outer, hole) for a, b in zip(ring, ring[1:] + ring[:1], strict=True)]
    table = as_blocks(spark, cells, width)
    outline = spark.createDataFrame(edges, "x1 double, y1 double, x2 double, y2 double")
    got = as_cells(blocks.clip_blocks(table, outline, width, res, ("v",)).collect(), width)
    pixels = spark.createDataFrame([(*k, v) for k, v in cells.items()], "cx long, cy long, v double")
    roi = spark.createDataFrame([(edges,)], f"edges {EDGE}")
    assert got == {(r.cx, r.cy): r.v for r in grid.clip(pixels, roi, res).collect()}
    kinds = blocks.outline_blocks(outline, width, res).collect()
    assert len({(r.bx, r.by) for r in kinds}) == len(kinds) and any(r.edges is None for r in kinds)


def plan_of(df, kind="executedPlan"):
    return getattr(df._jdf.queryExecution(), kind)().toString()


def test_blocks_from_cells_alone(spark):
    """Cells are grouped as they are, without rows for those that are not there, and may lie below 0."""
    cells = [(9, x, y, float(100 * x + y)) for x in (-5, -4, -1, 0, 3, 6) for y in (-3, 0, 7)]
    df = spark.createDataFrame(cells, "item_id long, cx long, cy long, v double").withColumn("w", F.when(F.col("cx") > 0, F.col("v")))
    made = composite.pixels_to_blocks(df, width=4, bands=("v", "w"))
    assert "Generate" not in plan_of(made)
    want = {}
    for _, x, y, v in cells:
        want.setdefault((x // 4, y // 4), [None] * 16)[y % 4 * 4 + x % 4] = v
    got = made.collect()
    assert {(r.bx, r.by): r.v for r in got} == want
    assert all(r.w == [v if r.bx * 4 + i % 4 > 0 else None for i, v in enumerate(r.v)] for r in got)


def test_looks_of_one_place_are_dealt(spark, tmp_path):
    looks = spark.range(4000).select(F.col("id").alias("item_id"), F.lit(0).alias("bx"), F.lit(0).alias("by"), F.array(F.rand(1), F.rand(2)).alias("v"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        blocks.write_blocks(looks, str(tmp_path / "looks"))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    per_file = spark.read.parquet(str(tmp_path / "looks")).groupBy(F.input_file_name()).count().collect()
    assert sum(r["count"] for r in per_file) == 4000 and max(r["count"] for r in per_file) < 2000


def test_outline_is_tested_before_looks_meet_it(spark):
    looks = spark.range(10).select(F.col("id").alias("item_id"), F.lit(0).alias("bx"), F.lit(0).alias("by"), F.array(*map(F.lit, [1.0, 2.0, 3.0, 4.0])).alias("v"))
    outline = spark.createDataFrame([(0.0, 0.0, 2.0, 0.0), (2.0, 0.0, 0.0, 1.9), (0.0, 1.9, 0.0, 0.0)], "x1 double, y1 double, x2 double, y2 double")
    cut = blocks.clip_blocks(looks, outline, 2, 1.0, ("v",))
    assert [r.v for r in cut.collect()] == [[1.0, None, None, None]] * 10
    above = plan_of(cut, "optimizedPlan").split("Join")[0]
    assert "x1" not in above and "_edges" not in above


def test_bands_of_a_cell_in_one_shuffle(spark):
    long = spark.createDataFrame([(1, 0, 0, "a", 2), (1, 0, 0, "a", 4), (1, 0, 0, "b", 7), (2, 1, 0, "b", None), (2, 1, 0, "c", 1)], "item_id long, cx long, cy long, band string, v long")
    wide = grid.wide_bands(long, ["a", "b"])
    assert sorted(map(tuple, wide.collect())) == [(1, 0, 0, 3.0, 7.0), (2, 1, 0, None, None)]
    assert plan_of(wide).split("Initial Plan")[0].count("Exchange hashpartitioning") == 1


def test_median_of_many_looks_meets_by_slices(spark):
    """A block's looks never meet in one group, whose rows are few however many looks there are."""
    import numpy as np

    looks = spark.range(0, 60_001, 1, 3).select(F.lit(1).cast("long").alias("bx"), F.lit(-1).cast("long").alias("by"), F.transform(F.sequence(F.lit(0), F.lit(19)), lambda i: F.when(F.xxhash64("id", i) % 3 != 0, (F.xxhash64("id", i) % 1000).cast("float"))).alias("v"), F.lit(None).cast("array<float>").alias("w"))
    med = composite.block_median(looks, bands=("v", "w"))
    assert "slice" in plan_of(med, "analyzed")
    stack = np.array([[np.nan if x is None else x for x in r.v] for r in looks.collect()], np.float32)
    (row,) = med.collect()
    assert (row.bx, row.by, row.w) == (1, -1, None) and row.v == np.nanmedian(stack, 0).tolist()
