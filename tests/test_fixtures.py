"""Cases with known results: equations, selection, types, geometry, state."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from orbitgrain.functions import masks as m
from orbitgrain.functions import predicates as p
from orbitgrain.functions import scalars as s
from orbitgrain.operators import compare, composite, grid, selection, upserts
from orbitgrain.operators.state import backfill_progress, discovery_window, windowed_status

SIX = "b03 double, b04 double, b05 double, b08 double, b8a double, b11 double"


def test_index_equations(spark):
    df = spark.createDataFrame([(0.3, 0.4, 0.45, 0.9, 0.85, 0.5), (0.0, 0.0, 0.1, 0.0, -0.1, 0.0), (None, 0.4, 0.1, 0.9, 0.1, 0.5)], SIX)
    a, b, c = m.with_indices(df).collect()
    assert (a.ndvi, a.gndvi, a.ndre, a.ndwi) == pytest.approx((0.5 / 1.3, 0.6 / 1.2, 0.4 / 1.3, 0.4 / 1.4))
    assert (b.ndvi, b.ndre) == (None, None)
    assert c.gndvi is None and c.ndvi is not None


def pixels(spark, rows):
    return spark.createDataFrame([(f"i{k}", datetime(2024, 6, k + 1), "t", 0, 0, *r) for k, r in enumerate(rows)], f"item_id string, acquired timestamp, tile_id string, cx long, cy long, {SIX}, scl int, cld int, qai int, terrain int, cloudmask int")


def test_scl_route(spark):
    px = pixels(spark, [(4000.0, 3000.0, 3500.0, 7000.0, 6800.0, 4500.0, 4, 10, 0, 0, 0), (500.0, 3200.0, 3700.0, 7200.0, 7000.0, 4700.0, 4, 10, 0, 0, 0)])
    r = composite.scl_composite(px, 2024, 6).first()
    assert (r.ndvi, r.gndvi, r.ndre, r.ndwi) == pytest.approx((0.4 / 0.8, 0.3 / 0.9, 0.33 / 0.83, 0.25 / 0.95), abs=5e-4)


def test_scl_unknown_class_passes_and_unknown_probability_fails(spark):
    ok = (4000.0, 3000.0, 3500.0, 7000.0, 6800.0, 4500.0)
    px = pixels(spark, [(*ok, None, 10, 0, 0, 0), (*ok, 4, None, 0, 0, 0), (*ok, 4, 30, 0, 0, 0), (*ok, 4, 31, 0, 0, 0)])
    assert [r.b03 is not None for r in m.screen_scl_cld(px).orderBy("item_id").collect()] == [True, False, True, False]


def test_orbit_v100(spark):
    first = (400.0, 300.0, 350.0, 700.0, 680.0, 350.0)
    px = pixels(spark, [(*first, 0, 0, 0, 0, 0), (*(x + 20 for x in first), 0, 0, 0, 0, 0)])
    r = composite.orbit_composite(px, 2024, 6, m.V100).first()
    assert (r.ndvi, r.gndvi, r.ndre, r.ndwi) == pytest.approx((0.4 / 1.02, 0.3 / 1.12, 0.33 / 1.05, 0.35 / 1.07), abs=5e-4)


def test_orbit_v200(spark):
    good, bad = (1700.0, 1500.0, 1800.0, 4000.0, 4200.0, 2800.0), (9000.0, 9000.0, 9000.0, 1100.0, 1100.0, 9000.0)
    px = pixels(spark, [(*good, 0, 0, 0, 45, 0), (*bad, 0, 0, 0, 45, 2), (*bad, 0, 0, 0, 120, 0), (*bad, 0, 0, 0, 200, 0)])
    r = composite.orbit_composite(px, 2024, 6, m.V200).first()
    assert [r[b] for b in m.BANDS] == pytest.approx([0.07, 0.05, 0.08, 0.30, 0.32, 0.18])
    assert (r.ndvi, r.gndvi, r.ndre, r.ndwi) == pytest.approx((0.25 / 0.35, 0.23 / 0.37, 0.24 / 0.40, 0.12 / 0.48), abs=5e-4)


def test_later_tile_wins_in_overlap(spark):
    px = pixels(spark, [(4000.0, 3000.0, 3500.0, 7000.0, 6800.0, 4500.0, 4, 10, 0, 0, 0)])
    both = px.unionByName(px.withColumns({"tile_id": F.lit("u"), "b03": F.lit(5000.0)}))
    assert composite.scl_composite(both, 2024, 6).first().b03 == pytest.approx(0.4)


def test_invalid_scale():
    for scale, offset in ((0, 0), (None, 0), (float("nan"), 0), (1, float("inf"))):
        with pytest.raises(ValueError):
            m.check_scale(scale, offset)


def test_bad_scales(spark):
    df = spark.createDataFrame([(1.0, 0.0), (0.0, 0.0), (None, 0.0), (float("nan"), 0.0)], "scale double, offset double")
    assert m.bad_scales(df).count() == 3


def test_month_and_window():
    assert p.month_bounds(2024, 12) == (datetime(2024, 12, 1), datetime(2025, 1, 1))
    with pytest.raises(ValueError):
        p.month_bounds(2014, 1)
    grid_ = ((100, 50), (1000.0, 10.0, 0.0, 2000.0, 0.0, -10.0))
    assert p.pixel_window((1015, 1801, 1041, 1979), *grid_) == (1, 2, 4, 18)
    assert p.pixel_window((1015, 1801, 1041, 1979), *grid_, buffer=2) == (0, 0, 7, 22)
    assert p.pixel_window((5000, 1801, 5041, 1979), *grid_) is None
    with pytest.raises(ValueError):
        p.pixel_window((0, 0, 1, 1), (1, 1), (0, 1, 0.5, 0, 0, -1))


def test_window_filters(spark):
    cells = spark.range(100).select(F.col("id").alias("cx"), F.lit(3).alias("cy"), F.lit(0).alias("bx"), F.lit(0).alias("by"))
    assert cells.filter(p.in_pixel_window((1, 2, 4, 18))).count() == 4
    assert cells.filter(p.blocks_in_window((1, 2, 4, 18))).count() == 100


@pytest.mark.parametrize(("types", "wanted"), [(["Byte", "UInt16"], "UInt16"), (["Int16", "UInt16"], "Int32"), (["Int32", "UInt32"], "Float64"), (["Float32", "UInt16"], "Float32"), (["Byte", "Int8"], "Int16"), (["Text"], None)])
def test_promotion(spark, types, wanted):
    assert spark.createDataFrame([(types,)], "t array<string>").select(grid.promoted_type(F.col("t"))).first()[0] == wanted


def test_nodata_choice(spark):
    pieces = spark.createDataFrame([("B04_10m", 0.0, "UInt16"), ("CLD_20m", None, "Byte")], "asset_key string, nodata double, data_type string")
    r = grid.chosen_nodata(pieces).first()
    assert (r.nodata, r.working_type) == (-9999.0, "Int32")


def test_complete_scenes(spark):
    keys = p.PROFILES["vegetation"]
    items = spark.createDataFrame([("earlier", "32TMT", datetime(2024, 6, 3), None), ("later", "32TMT", datetime(2024, 6, 20), 12.5), ("cloudy", "32TNT", datetime(2024, 6, 15), 45.0), ("incomplete", "32TNT", datetime(2024, 6, 15), 12.5), ("missing-file", "32TNT", datetime(2024, 6, 15), 12.5)], "item_id string, tile_id string, acquired timestamp, cloud_cover double")
    rows = [(r.item_id, k, None if (r.item_id, k) == ("missing-file", "B03_10m") else "f") for r in items.collect() for k in keys if (r.item_id, k) != ("incomplete", "CLD_20m")]
    assets = spark.createDataFrame(rows, "item_id string, asset_key string, local_path string")
    got = {r.item_id: r.reasons for r in selection.complete_scenes(items, assets, keys, 20, F.col("local_path").isNotNull()).collect()}
    assert got == {"earlier": [], "later": [], "cloudy": ["cloud-cover:45"], "incomplete": ["missing:CLD_20m"], "missing-file": ["missing-file:B03_10m"]}


def test_sliver_is_not_latest(spark):
    items = spark.createDataFrame([("full", "t", datetime(2026, 7, 15), 1.0), ("strip", "t", datetime(2026, 7, 16), 0.1)], "item_id string, tile_id string, acquired timestamp, area double")
    chosen, ignored = selection.bootstrap(items, ("acquired", "item_id"))
    assert [r.item_id for r in chosen.collect()] == ["full"] and [r.item_id for r in ignored.collect()] == ["strip"]


def test_version_choice(spark):
    rows = [("a", "0400", "160000"), ("b", "0512", "130000"), ("c", "0512", "142404")]
    df = spark.createDataFrame([("S2B", "x", "R1", "t", *r) for r in rows], "platform string, sensing string, orbit string, tile_id string, item_id string, baseline string, production string")
    assert [r.item_id for r in selection.newest_versions(df).collect()] == ["c"]


def test_boa_qai_reasons(spark):
    scenes = spark.createDataFrame([("complete", "complete"), ("failed", "failed")], "item_id string, force_status string")
    images = spark.createDataFrame([("complete", "BOA_MOSAIC", "a"), ("complete", "QAI_MOSAIC", "b")], "item_id string, image_type string, local_path string")
    got = {r.item_id: r.reasons for r in selection.boa_qai_pairs(scenes, images).collect()}
    assert got == {"complete": [], "failed": ["force-status:failed", "boa-mosaic-count:0", "qai-mosaic-count:0"]}


def test_stack_bands(spark):
    stacks = spark.createDataFrame([("i", "10m", ["B4", "B3", "B2", "B8"]), ("i", "20m", ["B8A", "B11", "B5"])], "item_id string, stack string, bands array<string>")
    got = {r.band: (r.stack, r.position) for r in p.band_positions(stacks).collect()}
    assert got == {"B03": ("10m", 2), "B04": ("10m", 1), "B05": ("20m", 3), "B08": ("10m", 4), "B8A": ("20m", 1), "B11": ("20m", 2)}


def diamond():
    c = [(7.0, 46.75), (7.5, 47.0), (8.0, 46.75), (7.5, 46.5)]
    return [(*a, *b) for a, b in zip(c, c[1:] + c[:1], strict=True)]


def test_cutline_with_edge_and_hole(spark):
    hole = [(7.4, 46.7), (7.6, 46.7), (7.6, 46.8), (7.4, 46.8)]
    edges = diamond() + [(*a, *b) for a, b in zip(hole, hole[1:] + hole[:1], strict=True)]
    pts = spark.createDataFrame([(7.2, 46.75, True), (7.5, 46.75, False), (7.25, 46.875, True), (7.0, 46.75, True), (7.05, 46.9, False)], "x double, y double, inside boolean")
    lit = F.array(*(F.struct(*(F.lit(v).alias(k) for k, v in zip(("x1", "y1", "x2", "y2"), e, strict=True))) for e in edges))
    assert all(r.inside == r.got for r in pts.withColumn("got", grid.inside_polygon(F.col("x"), F.col("y"), lit)).collect())


def test_regions(spark):
    from orbitgrain.sources.stac import regions_from_json

    square = '{"type":"Polygon","coordinates":[[[7,46],[8,46],[8,47],[7,47],[7,46]]]}'
    rows = [("geometry", square), ("feature", '{"type":"Feature","geometry":' + square + "}"), ("two", '{"type":"FeatureCollection","features":[{"geometry":' + square + '},{"geometry":{"type":"MultiPolygon","coordinates":[[[[9,46],[10,46],[10,47],[9,46]]]]}}]}'), ("flat", '{"type":"Polygon","coordinates":[[[7,46],[8,46],[7,46]]]}'), ("point", '{"type":"Point","coordinates":[7,46]}')]
    got = {r.roi_id: r for r in regions_from_json(spark.createDataFrame(rows, "roi_id string, value string")).collect()}
    assert got["geometry"].fingerprint == got["feature"].fingerprint
    assert (got["two"].west, got["two"].east, len(got["two"].polygons)) == (7.0, 10.0, 2)
    assert got["two"].valid and not got["flat"].valid and not got["point"].valid


def test_stac_documents(spark, tmp_path):
    import json

    from orbitgrain.sources.stac import read_inventory, read_stac_items

    good = {"id": "a", "collection": "c", "bbox": [8, 46, 9, 47], "geometry": {"type": "Polygon", "coordinates": [[[8, 46], [9, 46], [9, 47], [8, 46]]]}, "properties": {"eo:cloud_cover": 12.5}, "assets": {"B04_10m": {"href": "h", "file:size": 2048}}}
    (tmp_path / "a.json").write_text(json.dumps(good, indent=1))
    (tmp_path / "b.json").write_text("{ not json")
    (tmp_path / "c.json").write_text('{"collection": "c"}')
    items, failures = read_stac_items(spark, str(tmp_path))
    row = items.first()
    assert (row.id, row.assets["B04_10m"]["file:size"]) == ("a", 2048) and "12.5" in row.properties
    assert {r.reason for r in failures.collect()} == {"not-json", "no-id"}
    assert {r.length > 0 and len(r.sha256) == 64 for r in read_inventory(spark, str(tmp_path)).collect()} == {True}


def test_scalars(spark):
    row = spark.range(1).select(
        s.normal_checksum(F.lit("1220" + "ab" * 32)).alias("multihash"), s.normal_checksum(F.lit("")).alias("empty"), s.safe_component(F.lit("../a b/é.")).alias("safe"), s.safe_component(F.lit("..")).alias("unknown"),
        s.safe_suffix(F.lit("http://x/y.tif?z=1")).alias("suffix"), s.safe_suffix(F.lit("http://x/y")).alias("bin"), s.retry_delay(F.lit(3)).alias("delay"), s.json_or_text(F.lit("[1,2]")).alias("json"), s.json_or_text(F.lit("plain")).alias("text"),
        s.s3_parts(F.lit("s3://b/k/l")).alias("s3"), s.parse_time(F.lit("2024-06-30"), True).alias("end"), s.bbox_size(F.lit(7.0), F.lit(46.0), F.lit(8.0), F.lit(47.0), F.lit(1000.0)).alias("size"),
    ).first()
    assert row.multihash == "ab" * 32 and row.empty is None and row.safe == "a_b" and row.unknown == "unknown"
    assert (row.suffix, row.bin, row.delay, row.json, row.text) == (".tif", ".bin", 480.0, "[1,2]", "plain")
    assert (row.s3.bucket, row.s3.key, row.end) == ("b", "k/l", datetime(2024, 7, 1)) and row.size.height == 111


def test_histogram_edges(spark):
    df = spark.createDataFrame([("s", "i", x) for x in (-1.0, 1.0, 0.0, -1.5, 2.0, None)], "source string, index string, v double")
    rows = compare.histogram(df).orderBy("bin").collect()
    assert len(rows) == 64 and (rows[0].n, rows[63].n, rows[32].n, rows[0].underflow, rows[0].overflow) == (1, 1, 1, 1, 1)
    assert sum(r.density for r in rows) * 2 / 64 == pytest.approx(1)
    with pytest.raises(ValueError):
        compare.histogram(df, bins=8)


def test_agreement_of_empty_masks(spark):
    r = compare.agreement(spark.createDataFrame([(0, 0, 0, 10)], "both long, first_only long, second_only long, neither long")).first()
    assert (r.agreement_pct, r.iou, r.kappa) == (100.0, 1.0, 1.0)


def test_block_median(spark):
    look = lambda v: [v] * 4
    blocks = spark.createDataFrame([(0, 0, *([look(1.0)] * 6)), (0, 0, *([[3.0, None, 3.0, float("nan")]] * 6)), (0, 1, *([[None] * 4] * 6))], "bx int, by int, " + ", ".join(f"{b} array<float>" for b in m.BANDS))
    got = {(r.bx, r.by): r.b03 for r in composite.block_median(blocks).collect()}
    assert got == {(0, 0): [2.0, 1.0, 2.0, 1.0], (0, 1): [None] * 4}


def test_upsert_of_assets(spark):
    old = spark.createDataFrame([("i", "k", "h", "p", "completed", 2, 5, "x", None)], "item_id string, asset_key string, href string, local_path string, status string, attempts int, bytes long, sha256 string, last_error string")
    same, moved = (spark.createDataFrame([("i", "k", h, "p")], "item_id string, asset_key string, href string, local_path string") for h in ("h", "g"))
    r = upserts.upsert_assets(old, same).first()
    assert (r.status, r.attempts, r.bytes) == ("completed", 2, 5)
    r = upserts.upsert_assets(old, moved).first()
    assert (r.status, r.attempts, r.bytes, r.href) == ("queued", 0, None, "g")
    r = upserts.upsert_assets(old, moved, keep_results=True).first()
    assert (r.status, r.attempts, r.bytes) == ("queued", 2, 5)


def test_windows(spark):
    jobs = spark.createDataFrame([(datetime(2024, 1, d), st) for d, st in ((1, "completed"), (2, "retired"), (3, "queued"), (4, "completed"))], "item_datetime timestamp, status string")
    w = windowed_status(jobs, "2024-01-01")
    assert [r.state for r in w.orderBy("window").collect()] == ["complete", "complete_with_retired", "active", "complete"]
    r = backfill_progress(w, 10).first()
    assert (r["cursor"], r.done) == (2, 3)
    now = datetime(2026, 7, 17, 12)
    assert discovery_window(None, now)[0] == datetime(2026, 7, 14, 12)


def test_sinks(spark, tmp_path):
    from orbitgrain.sources import sinks

    cells = m.with_indices(spark.createDataFrame([(0, 0, 0.3, 0.4, 0.45, 0.9, 0.85, 0.5)], f"cx long, cy long, {SIX}"))
    out = sinks.write_month(cells, str(tmp_path), "l2a", 2024, 6, 20)
    assert out.endswith("source=l2a/year=2024/month=06/l2a_2024_06_20m") and spark.read.parquet(out).count() == 1
    with pytest.raises(Exception, match="(?i)exist"):
        sinks.write_month(cells, str(tmp_path), "l2a", 2024, 6, 20)
    sinks.write_month(cells, str(tmp_path), "l2a", 2024, 6, 20, overwrite=True)
    inputs = spark.createDataFrame([("a", 10.0, True, []), ("b", 90.0, False, ["cloud-cover:90"])], "item_id string, cloud_cover double, selected boolean, reasons array<string>")
    r = sinks.manifest(inputs, "p", "rule", {"total": 1.0}).first()
    assert (r.scene_count, r.mean_cloud, r.inputs, r.skipped[0].item_id) == (1, 10.0, ["a"], "b")
    item = sinks.composite_item(spark.createDataFrame([("p", 2024, 12, 7.0, 46.0, 8.0, 47.0, 20, 3)], "product string, year int, month int, west double, south double, east double, north double, gsd int, scene_count int")).first().value
    assert '"end_datetime":"2024-12-31T23:59:59.999999Z"' in item and '"provisional":false' in item
    items = spark.createDataFrame([("i", "c", "t", datetime(2024, 6, 1))], "item_id string, collection_id string, tile_id string, acquired timestamp")
    sinks.write_items(items, str(tmp_path / "items"))
    assert (tmp_path / "items" / "collection=c" / "year=2024" / "month=6" / "day=1" / "tile=t").is_dir()
    sinks.write_statistics(compare.band_statistics(spark.createDataFrame([("s", 6, "ndvi", 0.5)], "source string, month int, index string, v double"), ("source", "month", "index")), str(tmp_path / "st"))
    assert spark.read.json(str(tmp_path / "st" / "json")).first().indices[0]["index"] == "ndvi"


def test_block_median_without_some_arrays(spark):
    looks = [[1.0, 2.0, 4.0, 8.0], None, [3.0, None, 4.0, 2.0]]
    blocks = spark.createDataFrame([(0, 0, a, None) for a in looks] + [(0, 1, None, [1.0])], "bx int, by int, b03 array<float>, b04 array<float>")
    got = {r.by: (r.b03, r.b04) for r in composite.block_median(blocks, bands=("b03", "b04")).collect()}
    assert got == {0: ([2.0, 2.0, 4.0, 5.0], None), 1: (None, [1.0])}
    with pytest.raises(Exception, match="different lengths"):
        composite.block_median(spark.createDataFrame([(0, 0, [1.0]), (0, 0, [1.0, 2.0])], "bx int, by int, b03 array<float>"), bands=("b03",)).collect()


def test_blocks_of_full_width(spark):
    width = 512
    cells = spark.range(width * width).select(F.lit(1).cast("long").alias("item_id"), (F.col("id") % width).alias("cx"), F.expr(f"id div {width}").alias("cy"), (F.col("id") % 1000).cast("double").alias("b03"))
    blocks = composite.pixels_to_blocks(cells.filter("cx <> cy"), width=width, bands=("b03",))
    back = composite.blocks_to_pixels(blocks, width, ("b03",))
    assert back.count() == width * width and back.filter("b03 is null").count() == width
    assert back.join(cells.withColumnRenamed("b03", "want"), ["cx", "cy"]).filter("b03 <> want").count() == 0
