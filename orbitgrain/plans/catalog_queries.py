"""Queries over items, assets and jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orbitgrain.functions import predicates as p
from orbitgrain.functions import scalars as s
from orbitgrain.operators import audit, catalog, grid, selection, state, upserts
from orbitgrain.plans.registry import at, q
from orbitgrain.streaming import jobs

BOX = (7000000, 46000000, 7600000, 46500000)
SEVEN = ("B03_10m", "B04_10m", "B05_20m", "B08_10m", "B8A_20m", "B11_20m", "SCL_20m")
IN_BOX = "east >= 7000000 AND west <= 7600000 AND north >= 46000000 AND south <= 46500000"
CLEAR = "(cloud_cover IS NULL OR cloud_cover <= 20)"


@q("s02_search_items", f"SELECT item_id, {at('acquired')} AS acquired FROM items_v WHERE acquired >= TIMESTAMP '1995-01-01' AND acquired <= TIMESTAMP '1997-12-31' AND {IN_BOX} AND {CLEAR}")
def _(v):
    return catalog.search_items(v("items_v"), "1995-01-01", "1997-12-31", BOX, 20).select("item_id", ts("acquired"))


def ts(c: str):
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c)


@q("s03_collections", "SELECT DISTINCT collection_id FROM items_v")
def _(v):
    return catalog.list_collections(v("items_v"))


@q("s04_explode_assets", "SELECT item_id, asset_key, href, bytes FROM assets_v")
def _(v):
    nested = v("assets_v").groupBy("item_id").agg(F.map_from_entries(F.collect_list(F.struct("asset_key", F.struct("href", "bytes")))).alias("assets"))
    return catalog.explode_assets(nested)


@q("s09_find_products", """
WITH n AS (SELECT source, year(acquired) AS y, month(acquired) AS m, count(DISTINCT tile_id) AS k FROM pixels_v GROUP BY 1, 2, 3)
SELECT source, CAST(y AS INT) AS year, CAST(m AS INT) AS month, CASE WHEN k = 1 THEN '' ELSE 'manifest-count:' || k END AS reasons FROM n""")
def _(v):
    seen = v("pixels_v").select("source", F.year("acquired").alias("year"), F.month("acquired").alias("month"), "tile_id").distinct()
    asked = seen.select("source", "year", "month").distinct()
    kinds = asked.withColumn("kind", F.explode(F.array(F.lit("reflectance"), F.lit("indices")))).withColumn("path", F.concat_ws("/", "source", "year", "month", "kind"))
    many = seen.select("source", "year", "month", F.lit("manifest").alias("kind"), F.concat_ws("/", "source", "year", "month", "tile_id").alias("path"))
    return audit.find_products(kinds.unionByName(many), asked).select("source", "year", "month", F.array_join("reasons", ",").alias("reasons"))


@q("s14_queue_status", """SELECT item_id, CASE status WHEN 'completed' THEN 'DONE' WHEN 'failed' THEN 'FAIL' ELSE 'QUEUED' END AS queue FROM jobs_v""")
def _(v):
    jobs = v("jobs_v").select("item_id", F.col("item_datetime").alias("acquired"), F.lit("complete").alias("download_status"), F.when(F.col("status") == "completed", "complete").otherwise(F.col("status")).alias("force_status"), F.concat(F.lit("f/"), F.col("item_id").cast("string")).alias("local_path"))
    return audit.queue_status(jobs)[0].select("item_id", "queue")


@q("s15_event_log", "SELECT item_id, 'processing' AS message, '{\"attempts\":' || attempts || '}' AS details FROM jobs_v WHERE status = 'processing'")
def _(v):
    jobs = v("jobs_v").filter("status = 'processing'").withColumn("asset_key", F.lit(None).cast("string"))
    return state.append_events(jobs, "processing", details={"attempts": "attempts"}).select("item_id", "message", "details")


@q("s16_settings", "SELECT 'k' || o_orderkey AS key, CASE WHEN o_orderkey % 2 = 0 THEN CAST(o_custkey AS VARCHAR) ELSE o_orderstatus END AS value FROM orders")
def _(v):
    rows = v("orders").select(F.concat(F.lit("k"), F.col("o_orderkey").cast("string")).alias("key"), F.when(F.col("o_orderkey") % 2 == 0, F.col("o_custkey").cast("string")).otherwise(F.to_json(F.struct(F.col("o_orderstatus").alias("v")))).alias("value"))
    quoted = rows.withColumn("value", F.when(F.col("value").startswith("{"), F.concat(F.lit('"'), F.get_json_object("value", "$.v"), F.lit('"'))).otherwise(F.col("value")))
    return state.read_settings(quoted)


@q("p01_bbox", f"SELECT item_id FROM items_v WHERE {IN_BOX}")
def _(v):
    return v("items_v").filter(p.bbox_intersects(*BOX)).select("item_id")


@q("p02_time_range", "SELECT item_id FROM items_v WHERE acquired >= TIMESTAMP '1994-03-01' AND acquired < TIMESTAMP '1996-03-01'")
def _(v):
    return v("items_v").filter(p.in_time_range("acquired", "1994-03-01", "1996-03-01", half_open=True)).select("item_id")


@q("p03_month", "SELECT year(acquired) * 100 + month(acquired) AS month, count(*) AS n FROM items_v GROUP BY 1")
def _(v):
    return v("items_v").groupBy((F.year("acquired").cast("long") * 100 + F.month("acquired")).alias("month")).agg(F.count(F.lit(1)).alias("n"))


@q("p04_cloud_cover", f"SELECT item_id FROM items_v WHERE {CLEAR}")
def _(v):
    return v("items_v").filter(p.cloud_at_most(20)).select("item_id")


@q("p05_completed", "SELECT item_id, asset_key FROM assets_v WHERE status = 'completed'")
def _(v):
    return v("assets_v").filter(p.completed_only()).select("item_id", "asset_key")


@q("p06_asset_keys", "SELECT item_id, asset_key FROM assets_v WHERE asset_key IN ('B04_10m', 'B08_10m')")
def _(v):
    return v("assets_v").filter(p.asset_key_in(["B04_10m", "B08_10m", "B04_10m"])).select("item_id", "asset_key")


@q("p07_is_raster", "SELECT item_id, asset_key, coalesce(media, '') LIKE 'image/%' OR regexp_matches(lower(href), '\\.(jp2|tiff?|vrt)$') AS is_raster FROM assets_v")
def _(v):
    return v("assets_v").select("item_id", "asset_key", p.is_raster(F.col("media"), F.col("href")).alias("is_raster"))


@q("p08_resolution", "SELECT item_id, asset_key, CASE WHEN asset_key LIKE '%10m' THEN 10.0e0 ELSE 20.0e0 END AS resolution FROM assets_v")
def _(v):
    return v("assets_v").select("item_id", "asset_key", p.asset_resolution(F.col("asset_key"), F.lit(None).cast("double")).alias("resolution"))


@q("p09_epsg", "SELECT item_id, asset_key, CAST(epsg AS INT) AS epsg FROM assets_v")
def _(v):
    return v("assets_v").select("item_id", "asset_key", p.asset_epsg(F.lit(None).cast("int"), F.concat(F.lit("epsg:"), F.col("epsg").cast("string"))).alias("epsg"))


NAME = "platform || '_MSIL1C_' || strftime(acquired, '%Y%m%dT%H%M%S') || '_N0' || baseline || '_R' || lpad(CAST(orbit AS VARCHAR), 3, '0') || '_T32T' || CASE tile_id % 3 WHEN 0 THEN 'MT' WHEN 1 THEN 'NT' ELSE 'LS' END || '_20200101T000000'"


def product_names(v) -> DataFrame:
    tile = F.when(F.col("tile_id") % 3 == 0, "MT").when(F.col("tile_id") % 3 == 1, "NT").otherwise("LS")
    name = F.concat("platform", F.lit("_MSIL1C_"), F.date_format("acquired", "yyyyMMdd'T'HHmmss"), F.lit("_N0"), F.col("baseline").cast("string"), F.lit("_R"), F.lpad(F.col("orbit").cast("string"), 3, "0"), F.lit("_T32T"), tile, F.lit("_20200101T000000"))
    return v("items_v").withColumn("name", name)


@q("p10_tile_id", "SELECT item_id, '32T' || CASE tile_id % 3 WHEN 0 THEN 'MT' WHEN 1 THEN 'NT' ELSE 'LS' END AS tile FROM items_v")
def _(v):
    return product_names(v).select("item_id", p.tile_id(F.col("name"), F.lit(None).cast("string")).alias("tile"))


@q("p11_item_datetime", f"SELECT item_id, {at('acquired')} AS acquired FROM items_v")
def _(v):
    texts = v("items_v").withColumns({"a": F.when(F.col("item_id") % 2 == 0, s.iso_z(F.col("acquired"))), "b": F.date_format("acquired", "yyyy-MM-dd'T'HH:mm:ss")})
    return texts.withColumn("acquired", p.item_datetime(F.col("a"), F.col("b"))).select("item_id", ts("acquired"))


@q("p12_product_names", f"""SELECT item_id, platform, strftime(acquired, '%Y%m%dT%H%M%S') AS sensing, '0' || baseline AS baseline, lpad(CAST(orbit AS VARCHAR), 3, '0') AS orbit FROM items_v""")
def _(v):
    parts = p.parse_product(F.col("name"))
    return product_names(v).select("item_id", *(parts[k].alias(k) for k in ("platform", "sensing", "baseline", "orbit")))


@q("p13_sensors", "SELECT item_id FROM items_v WHERE platform IN ('S2A', 'S2B')")
def _(v):
    return v("items_v").filter(p.sensor_in(["S2A", "S2B"])).select("item_id")


@q("p16_profile", "SELECT asset_key, count(*) AS n FROM assets_v WHERE asset_key IN ('B04_10m', 'B08_10m', 'SCL_20m', 'CLD_20m') GROUP BY 1")
def _(v):
    assets = v("assets_v")
    return assets.join(F.broadcast(p.profile_table(assets.sparkSession, "ndvi")), "asset_key").groupBy("asset_key").agg(F.count(F.lit(1)).alias("n"))


@q("p17_select_one", "SELECT item_id, CASE WHEN count(*) FILTER (asset_key LIKE '%20m') = 1 THEN min(asset_key) FILTER (asset_key LIKE '%20m') END AS asset_key FROM assets_v GROUP BY 1")
def _(v):
    named = v("assets_v").withColumn("title", F.when(F.col("asset_key").endswith("20m"), "Twenty"))
    return p.select_one(named, title="twenty").select("item_id", "asset_key")


@q("p18_band_positions", """
WITH s AS (SELECT item_id, split_part(asset_key, '_', 1) AS band, row_number() OVER (PARTITION BY item_id ORDER BY asset_key) AS position FROM assets_v)
SELECT item_id, band, position FROM s WHERE band IN ('B03', 'B04', 'B05', 'B08', 'B8A', 'B11')""")
def _(v):
    stacks = v("assets_v").groupBy("item_id").agg(F.transform(F.array_sort(F.collect_list("asset_key")), lambda k: F.split_part(k, F.lit("_"), F.lit(1))).alias("bands")).withColumn("stack", F.lit("all"))
    return p.band_positions(stacks).filter("position is not null").select("item_id", "band", F.col("position").cast("long").alias("position"))


@q("p19_required_assets", "SELECT item_id, count(*) FILTER (asset_key IN ('B04_10m', 'B08_10m')) = 2 AS ok FROM assets_v GROUP BY 1")
def _(v):
    titles = v("assets_v").groupBy("item_id").agg(F.collect_list("asset_key").alias("titles"))
    return titles.select("item_id", p.has_all("titles", ["b04_10M", "B08_10m"]).alias("ok"))


@q("p20_missing_assets", """
WITH k AS (SELECT unnest(['B03_10m', 'B04_10m', 'B05_20m', 'B08_10m', 'B8A_20m', 'B11_20m', 'SCL_20m']) AS asset_key),
m AS (SELECT i.item_id, k.asset_key FROM items_v i CROSS JOIN k ANTI JOIN assets_v a ON a.item_id = i.item_id AND a.asset_key = k.asset_key),
g AS (SELECT item_id, string_agg(asset_key, ',' ORDER BY asset_key) AS missing, count(*) AS n FROM m GROUP BY 1)
SELECT i.item_id, coalesce(missing, '') AS missing, CAST(coalesce(n, 0) AS INT) AS n_missing FROM items_v i LEFT JOIN g USING (item_id)""")
def _(v):
    return selection.discovery_audit(v("items_v"), v("assets_v"), SEVEN)


@q("p21_throttling", "SELECT event_id, event_type = 'signup' OR (CASE WHEN user_id % 7 = 0 THEN 429 ELSE 200 END) = 429 AS throttled, CASE WHEN event_id % 2 = 0 THEN CAST(json_extract_string(props, '$.k') AS DOUBLE) ELSE 60.0e0 END AS wait FROM events")
def _(v):
    e = v("events")
    now = F.col("ts").cast("timestamp")
    date = F.concat(F.date_format(now + F.expr("INTERVAL 60 SECONDS"), "EEE, dd MMM yyyy HH:mm:ss"), F.lit(" GMT"))
    value = F.when(F.col("event_id") % 2 == 0, F.get_json_object("props", "$.k")).otherwise(date)
    throttled = p.is_throttled(F.when(F.col("user_id") % 7 == 0, 429).otherwise(200), F.when(F.col("event_type") == "signup", "SlowDown"))
    return e.select("event_id", throttled.alias("throttled"), p.retry_after_seconds(value, now).alias("wait"))


@q("j01_raster_pieces", f"SELECT item_id, asset_key, tile_id, {at('acquired')} AS acquired FROM items_v JOIN assets_v a USING (item_id) WHERE {IN_BOX} AND {CLEAR} AND a.status = 'completed' AND asset_key IN ('B04_10m', 'B08_10m')")
def _(v):
    assets = v("assets_v").withColumn("is_raster", F.lit(True))
    return catalog.raster_pieces(v("items_v").drop("status"), assets, ["B04_10m", "B08_10m"], BOX, max_cloud=20).select("item_id", "asset_key", "tile_id", ts("acquired"))


@q("j02_boa_qai_pairs", """
WITH i AS (SELECT item_id, count(*) FILTER (asset_key LIKE 'B%10m') AS boa, count(*) FILTER (asset_key = 'SCL_20m') AS qai FROM assets_v GROUP BY 1)
SELECT j.item_id, j.status = 'completed' AND coalesce(boa, 0) = 1 AND coalesce(qai, 0) = 1 AS selected,
 concat_ws(',', CASE WHEN j.status <> 'completed' THEN 'force-status:' || j.status END, CASE WHEN coalesce(boa, 0) <> 1 THEN 'boa-mosaic-count:' || coalesce(boa, 0) END, CASE WHEN coalesce(qai, 0) <> 1 THEN 'qai-mosaic-count:' || coalesce(qai, 0) END) AS reasons
FROM jobs_v j LEFT JOIN i USING (item_id)""")
def _(v):
    kind = F.when(F.col("asset_key").rlike("^B.*10m$"), "BOA_MOSAIC").when(F.col("asset_key") == "SCL_20m", "QAI_MOSAIC")
    images = v("assets_v").select("item_id", kind.alias("image_type"), F.coalesce("local_path", F.lit("x")).alias("local_path")).filter("image_type is not null")
    scenes = v("jobs_v").select("item_id", F.when(F.col("status") == "completed", "complete").otherwise(F.col("status")).alias("force_status"))
    return selection.boa_qai_pairs(scenes, images).select("item_id", "selected", F.array_join("reasons", ",").alias("reasons"))


@q("j03_complete_scenes", """
WITH a AS (SELECT item_id, count(*) AS n, count(local_path) AS f FROM assets_v GROUP BY 1)
SELECT i.item_id, coalesce(n, 0) = 7 AND coalesce(f, 0) = 7 AND (cloud_cover IS NULL OR cloud_cover <= 60) AS selected,
 CAST(7 - coalesce(n, 0) + coalesce(n, 0) - coalesce(f, 0) + CASE WHEN cloud_cover > 60 THEN 1 ELSE 0 END AS INT) AS n_reasons
FROM items_v i LEFT JOIN a USING (item_id)""")
def _(v):
    out = selection.complete_scenes(v("items_v"), v("assets_v"), SEVEN, 60, F.col("local_path").isNotNull())
    return out.select("item_id", "selected", F.size("reasons").alias("n_reasons"))


@q("j04_available", "SELECT item_id, asset_key FROM assets_v WHERE local_path IS NOT NULL AND item_id % 3 <> 0")
def _(v):
    assets = v("assets_v")
    inventory = assets.filter("local_path is not null").select(F.col("local_path").alias("path"), (F.col("bytes") + F.when(F.col("item_id") % 3 == 0, 1).otherwise(0)).alias("length"))
    return selection.available_pieces(assets, inventory)[0].select("item_id", "asset_key")


@q("j07_new_items", "SELECT item_id FROM items_v i ANTI JOIN (SELECT user_id AS item_id FROM events) e USING (item_id)")
def _(v):
    return selection.new_items(v("items_v"), v("attempts_v")).select("item_id")


@q("j08_ignored_items", "SELECT item_id FROM items_v ANTI JOIN (SELECT item_id FROM jobs_v WHERE status IN ('failed', 'retired')) j USING (item_id)")
def _(v):
    return selection.new_items(v("items_v"), v("jobs_v").filter("status in ('failed', 'retired')")).select("item_id")


@q("j11_spatial_join", """
WITH r AS (SELECT s_suppkey AS region_id, 5960000 + (s_suppkey * 7919 % 4000) * 1000 AS west, 45820000 + (s_suppkey * 104729 % 1800) * 1000 AS south FROM supplier)
SELECT region_id, count(*) AS n, CAST(sum(item_id) AS BIGINT) AS ids FROM r JOIN items_v i ON i.east >= r.west AND i.west <= r.west + 50000 AND i.north >= r.south AND i.south <= r.south + 50000 GROUP BY 1""")
def _(v):
    sid = F.col("s_suppkey")
    regions = v("supplier").select(sid.alias("region_id"), (5960000 + (sid * 7919 % 4000) * 1000).alias("west"), (45820000 + (sid * 104729 % 1800) * 1000).alias("south"))
    regions = regions.withColumns({"east": F.col("west") + 50000, "north": F.col("south") + 50000})
    return grid.spatial_totals(regions, v("items_v"), 250_000.0)


@q("j11_levels", """
WITH r AS (SELECT s_suppkey AS region_id, 5960000 + (s_suppkey * 7919 % 4000) * 1000 AS west, 45820000 + (s_suppkey * 104729 % 1800) * 1000 AS south, 1000 * (1 << CAST(s_suppkey % 13 AS INT)) AS width FROM supplier)
SELECT region_id, count(*) AS n, CAST(sum(item_id) AS BIGINT) AS ids FROM r JOIN items_v i ON i.east >= r.west AND i.west <= r.west + width AND i.north >= r.south AND i.south <= r.south + width GROUP BY 1""")
def _(v):
    sid = F.col("s_suppkey")
    regions = v("supplier").select(sid.alias("region_id"), (5960000 + (sid * 7919 % 4000) * 1000).alias("west"), (45820000 + (sid * 104729 % 1800) * 1000).alias("south"), (1000 * F.pow(F.lit(2), sid % 13)).cast("long").alias("width"))
    regions = regions.withColumns({"east": F.col("west") + F.col("width"), "north": F.col("south") + F.col("width")})
    return grid.spatial_totals(regions, v("items_v"), 10_000.0, grid.spatial_join_levels)


@q("j13_product_grid", """
WITH g AS (SELECT s, m FROM (SELECT unnest(['l2a', 'boa', 'orbit', 'none']) AS s) a CROSS JOIN (SELECT unnest([6, 7, 8]) AS m) b),
n AS (SELECT source, month(acquired) AS m, count(DISTINCT year(acquired)) AS k FROM pixels_v GROUP BY 1, 2)
SELECT s AS source, CAST(g.m AS INT) AS month, CASE WHEN k IS NULL THEN 'missing' ELSE 'duplicate' END AS reason FROM g LEFT JOIN n ON n.source = s AND n.m = g.m WHERE k IS NULL OR k <> 1""")
def _(v):
    from orbitgrain.operators import compare

    products = v("pixels_v").select("source", F.month("acquired").alias("month"), F.year("acquired").alias("year")).distinct()
    return compare.missing_products(products, ["l2a", "boa", "orbit", "none"], [6, 7, 8])


@q("j14_provenance", """
WITH s AS (SELECT tile_id AS product, item_id % 2 AS side, platform, orbit FROM items_v), a AS (SELECT product, side, list_sort(list_distinct(list(platform || orbit))) AS l FROM s GROUP BY 1, 2)
SELECT x.product, CASE WHEN a.l IS NULL OR b.l IS NULL THEN 'not-available' WHEN a.l = b.l THEN 'matched' ELSE 'mismatched' END AS match
FROM (SELECT DISTINCT product FROM s) x LEFT JOIN a ON a.product = x.product AND a.side = 0 LEFT JOIN a b ON b.product = x.product AND b.side = 1""")
def _(v):
    from orbitgrain.operators import compare

    rows = v("items_v").select(F.col("tile_id").alias("product"), F.when(F.col("item_id") % 2 == 0, "a").otherwise("b").alias("side"), "platform", F.lit("x").alias("sensing"), "orbit", F.lit("t").alias("tile"))
    return compare.provenance_match(rows, "a", "b")


@q("j15_reconcile", """SELECT item_id, asset_key, CASE WHEN item_id % 5 = 0 THEN 'missing' WHEN item_id % 5 = 1 THEN 'extra' WHEN item_id % 5 = 2 THEN 'size' WHEN item_id % 5 = 3 THEN 'hash' ELSE 'ok' END AS class FROM assets_v""")
def _(v):
    a, k = v("assets_v"), F.col("item_id") % 5
    want = a.filter(k != 1).select("item_id", "asset_key", F.col("bytes").alias("size"), F.lit("h").alias("sha256"))
    got = a.filter(k != 0).select("item_id", "asset_key", (F.col("bytes") + F.when(k == 2, 1).otherwise(0)).alias("size"), F.when(k == 3, "g").otherwise("h").alias("sha256"))
    return audit.reconcile(want, got, ("item_id", "asset_key"))


LATEST = """WITH f AS (SELECT *, max(area) OVER (PARTITION BY tile_id) AS top FROM {t}), r AS (SELECT *, row_number() OVER (PARTITION BY tile_id ORDER BY {o}) AS rn FROM f WHERE area >= 0.9 * top) SELECT tile_id, item_id FROM r WHERE rn = 1"""


@q("w01_latest_complete", LATEST.format(t="(SELECT i.* FROM items_v i SEMI JOIN (SELECT item_id FROM assets_v WHERE asset_key IN ('B04_10m', 'B08_10m') GROUP BY 1 HAVING count(*) = 2) c USING (item_id))", o="acquired DESC, item_id DESC"))
def _(v):
    return selection.latest_per_tile(selection.complete_items(v("items_v"), v("assets_v"), ["B04_10m", "B08_10m"])).select("tile_id", "item_id")


@q("w02_bootstrap", LATEST.format(t="items_v", o="acquired DESC, published DESC, item_id DESC"))
def _(v):
    return selection.bootstrap(v("items_v"))[0].select("tile_id", "item_id")


@q("w02_ignored", f"WITH x AS ({LATEST.format(t='items_v', o='acquired DESC, published DESC, item_id DESC')}) SELECT item_id FROM items_v ANTI JOIN x USING (item_id)")
def _(v):
    return selection.bootstrap(v("items_v"))[1].select("item_id")


@q("w03_versions", "WITH r AS (SELECT *, row_number() OVER (PARTITION BY platform, CAST(acquired AS DATE), orbit, tile_id ORDER BY baseline DESC, production DESC, item_id DESC) AS rn FROM items_v) SELECT item_id, CAST(baseline AS BIGINT) AS baseline FROM r WHERE rn = 1")
def _(v):
    scenes = v("items_v").withColumn("sensing", F.to_date("acquired")).select("platform", "sensing", "orbit", "tile_id", "baseline", "production", "item_id")
    return selection.newest_versions(scenes).select("item_id", F.col("baseline").cast("long").alias("baseline"))


@q("w04_newest_in_order", "SELECT item_id FROM (SELECT item_id FROM items_v ORDER BY acquired DESC, item_id DESC LIMIT 50)")
def _(v):
    return catalog.newest_in_order(v("items_v"), 50).select("item_id")


@q("w05_last_events", "WITH r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY event_id DESC) AS rn FROM attempts_v) SELECT item_id, event_id, outcome FROM r WHERE rn <= 20")
def _(v):
    return catalog.last_events(v("attempts_v")).select("item_id", "event_id", "outcome")


@q("w06_newest", "SELECT item_id FROM items_v ORDER BY acquired DESC, item_id DESC LIMIT 1")
def _(v):
    return catalog.newest_item(v("items_v")).select("item_id")


@q("w07_largest_footprint", "SELECT item_id, max(area) OVER (PARTITION BY tile_id) AS tile_area FROM items_v")
def _(v):
    return selection.largest_footprint(v("items_v")).select("item_id", "tile_area")


@q("a16_summary", "SELECT (SELECT count(*) FROM items_v) AS items, count(*) AS assets, count(*) FILTER (status = 'completed') AS completed_assets, CAST(coalesce(sum(bytes) FILTER (status = 'completed'), 0) AS BIGINT) AS completed_bytes FROM assets_v")
def _(v):
    return catalog.dataset_summary(v("items_v"), v("assets_v"))


@q("a17_status_counts", "SELECT status, count(*) AS n FROM jobs_v WHERE item_datetime >= TIMESTAMP '1994-01-01' AND item_datetime < TIMESTAMP '1997-01-01' GROUP BY 1")
def _(v):
    return state.status_counts(v("jobs_v"), "1994-01-01", "1997-01-01")


@q("a18_next_retry", f"SELECT {at('min(next_attempt_at)')} AS next_attempt_at FROM jobs_v WHERE status = 'retry_wait'")
def _(v):
    return state.next_retry(v("jobs_v")).select(ts("next_attempt_at"))


@q("a19_mean_metadata", "SELECT round(avg(cloud_cover), 6) AS mean_cloud, count(*) AS scenes FROM items_v")
def _(v):
    return catalog.mean_metadata(v("items_v"), "cloud_cover").select(F.round("mean_cloud_cover", 6).alias("mean_cloud"), "scenes")


@q("a20_pieces_per_key", "SELECT asset_key, count(*) AS pieces, CAST(sum(bytes) AS BIGINT) AS bytes, count(*) FILTER (local_path IS NULL) AS missing_files FROM assets_v GROUP BY 1")
def _(v):
    return catalog.pieces_per_key(v("assets_v"))


@q("a21_run_results", "SELECT item_id, count(*) FILTER (status = 'completed' AND local_path IS NOT NULL) AS ok, count(*) FILTER (status <> 'completed' AND local_path IS NOT NULL) AS skipped, count(*) FILTER (local_path IS NULL) AS failed, count(*) FILTER (local_path IS NULL) = 0 AS complete FROM assets_v GROUP BY 1")
def _(v):
    outcome = F.when(F.col("local_path").isNull(), "failed").when(F.col("status") == "completed", "ok").otherwise("skipped")
    return audit.run_results(v("assets_v").select("item_id", "asset_key", outcome.alias("outcome")))


@q("a22_safe_audit", """
WITH g AS (SELECT l_orderkey AS product, l_suppkey % 2 AS granule, list_sort(list_distinct(list(l_linenumber))) AS bands, count(*) AS files FROM lineitem GROUP BY 1, 2)
SELECT product, count(*) AS granules, count(*) FILTER (len(bands) <> 7 OR files <> 7) AS bad_granules, count(*) FILTER (len(bands) <> 7 OR files <> 7) = 0 AS complete FROM g GROUP BY 1""")
def _(v):
    folder = F.concat(F.lit("GRANULE/G"), (F.col("l_suppkey") % 2).cast("string"))
    lines = v("lineitem").select(F.col("l_orderkey").alias("product"), folder.alias("g"), "l_linenumber")
    images = lines.select("product", F.concat("g", F.lit("/IMG_DATA/T_B0"), F.col("l_linenumber").cast("string"), F.lit(".jp2")).alias("path"))
    meta = lines.select("product", F.concat("g", F.lit("/MTD_TL.xml")).alias("path")).distinct()
    roots = lines.select("product").distinct().select("product", F.explode(F.array(*map(F.lit, audit.ROOT_FILES))).alias("path"))
    return audit.safe_audit(images.unionByName(meta).unionByName(roots), [f"B0{i}" for i in range(1, 8)]).select("product", "granules", "bad_granules", "complete")


@q("a23_set_fingerprint", """
SELECT item_id AS product, sha256('[' || string_agg('{"path":"' || asset_key || '","size":' || bytes || ',"etag":"e"}', ',' ORDER BY asset_key) || ']') AS fingerprint FROM assets_v GROUP BY 1""")
def _(v):
    objects = v("assets_v").select(F.col("item_id").alias("product"), F.col("asset_key").alias("path"), F.col("bytes").alias("size"), F.lit("e").alias("etag"))
    return audit.set_fingerprint(objects)


def level2_files(v) -> DataFrame:
    kind = F.when(F.col("l_linenumber") % 3 == 0, "BOA").when(F.col("l_linenumber") % 3 == 1, "QAI").otherwise("OVV")
    return v("lineitem").select(F.col("l_orderkey").alias("job"), kind.alias("kind"), F.col("l_quantity").cast("long").alias("length"), (F.col("l_suppkey") % 4 == 0).alias("mosaic"), F.col("l_shipdate").cast("timestamp").alias("modified"))


@q("a24_level2_status", """
WITH f AS (SELECT l_orderkey AS item_id, count(*) FILTER (l_linenumber % 3 = 0) AS boa, count(*) FILTER (l_linenumber % 3 = 1) AS qai, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS bytes FROM lineitem GROUP BY 1)
SELECT j.item_id AS job, coalesce(boa, 0) AS boa, coalesce(qai, 0) AS qai, coalesce(bytes, 0) AS bytes,
 CASE WHEN status = 'completed' THEN 'complete' WHEN status = 'failed' THEN 'failed' WHEN j.item_id % 2 = 0 THEN 'validation-or-mosaic' WHEN coalesce(boa, 0) > 0 OR coalesce(qai, 0) > 0 THEN 'writing-force-tiles' ELSE 'force-l2ps-core' END AS phase
FROM jobs_v j LEFT JOIN f USING (item_id)""")
def _(v):
    jobs = v("jobs_v").select(F.col("item_id").alias("job"), F.when(F.col("status") == "completed", "complete").otherwise(F.col("status")).alias("status"), F.when(F.col("item_id") % 2 == 0, "DONE").otherwise("QUEUED").alias("queue_status"), F.lit(None).cast("string").alias("progress_phase"), F.col("item_datetime").alias("started_at"))
    return audit.level2_status(jobs, level2_files(v)).select("job", "boa", "qai", "bytes", "phase")


@q("a25_output_triples", """
WITH f AS (SELECT l_orderkey AS job, l_linenumber % 3 AS k, l_suppkey % 4 = 0 AS mosaic FROM lineitem),
c AS (SELECT job, count(*) FILTER (NOT mosaic AND k = 0) AS boa, count(*) FILTER (NOT mosaic AND k = 1) AS qai, count(*) FILTER (NOT mosaic AND k = 2) AS ovv, count(DISTINCT CASE WHEN mosaic AND k < 2 THEN k END) AS mosaics FROM f GROUP BY 1)
SELECT job, boa, qai, ovv, boa > 0 AND boa = qai AND boa = ovv AND mosaics = 2 AS ok FROM c""")
def _(v):
    return audit.output_triples(level2_files(v)).select("job", "boa", "qai", "ovv", "ok")


@q("a28_cube_audit", """
WITH h AS (SELECT l_orderkey AS job, l_suppkey % 3 AS tx, l_linenumber % 3 AS kind, 100 + CASE WHEN l_partkey % 17 = 0 THEN 1 ELSE 0 END AS width FROM lineitem),
g AS (SELECT job, tx, count(DISTINCT kind) AS kinds, count(DISTINCT width) AS grids FROM h GROUP BY 1, 2)
SELECT job, 'X000' || tx || '_Y0001' AS tile, concat_ws(',', CASE WHEN kinds < 3 THEN 'kinds' END, CASE WHEN grids > 1 THEN 'grid' END) AS problems FROM g WHERE kinds < 3 OR grids > 1""")
def _(v):
    tx = F.col("l_suppkey") % 3
    headers = v("lineitem").select(F.col("l_orderkey").alias("job"), (F.col("l_linenumber") % 3).alias("kind"), F.concat(F.lit("X000"), tx.cast("string"), F.lit("_Y0001")).alias("tile"), (100 + F.when(F.col("l_partkey") % 17 == 0, 1).otherwise(0)).alias("width"), F.lit(100).alias("height"), (tx * 30000).alias("origin_x"), F.lit(-30000).alias("origin_y"), F.lit(1).alias("length"))
    return audit.cube_audit(headers, 0.0, 0.0, 30000.0).select("job", "tile", F.array_join("problems", ",").alias("problems"))


@q("o01_piece_order", f"SELECT item_id, asset_key, row_number() OVER (PARTITION BY tile_id ORDER BY acquired, asset_key, item_id) AS place FROM items_v JOIN assets_v USING (item_id)")
def _(v):
    from pyspark.sql import Window

    pieces = v("items_v").join(v("assets_v").drop("status"), "item_id")
    order = Window.partitionBy("tile_id").orderBy("acquired", "asset_key", "item_id")
    return pieces.select("item_id", "asset_key", F.row_number().over(order).cast("long").alias("place"))


@q("o02_due_jobs", "SELECT item_id, status FROM jobs_v WHERE status = 'queued' OR (status = 'retry_wait' AND next_attempt_at <= TIMESTAMP '1996-01-01') ORDER BY item_datetime, item_id LIMIT 100")
def _(v):
    return state.due_jobs(v("jobs_v"), "1996-01-01", 100).select("item_id", "status")


@q("o04_difference", "SELECT DISTINCT tile_id FROM items_v ANTI JOIN (SELECT tile_id FROM items_v WHERE cloud_cover <= 1) x USING (tile_id)")
def _(v):
    return selection.tiles_without(v("items_v"), v("items_v").filter("cloud_cover <= 1"))


@q("o05_intersection", "SELECT CAST(CAST(acquired AS DATE) AS VARCHAR) AS date FROM items_v GROUP BY 1 HAVING count(DISTINCT platform) = 3")
def _(v):
    dates = v("items_v").select(F.to_date("acquired").cast("string").alias("date"), "platform")
    return dates.filter("platform = 'S2A'").select("date").intersect(dates.filter("platform = 'S2B'").select("date")).intersect(dates.filter("platform = 'S2C'").select("date"))


@q("o07_first_of_each", "SELECT asset_key, min(item_id) AS item_id FROM assets_v GROUP BY 1")
def _(v):
    return catalog.first_of_each(v("assets_v"), "asset_key", "item_id")


@q("r08_band_contract", """SELECT asset_key, count(DISTINCT raster_offset) AS transforms, CASE WHEN count(DISTINCT raster_offset) = 1 THEN min(raster_offset) END AS "offset", bool_or(nodata IS NULL) AS zero_is_valid, string_agg(DISTINCT data_type, ',' ORDER BY data_type) AS data_types FROM assets_v GROUP BY 1""")
def _(v):
    return grid.band_contract(v("assets_v")).select("asset_key", "transforms", "offset", "zero_is_valid", F.array_join("data_types", ",").alias("data_types"))


@q("r09_nodata", "SELECT -9999.0e0 AS nodata, 'Int32' AS source_type, 'Int32' AS working_type FROM assets_v GROUP BY ALL HAVING count(*) > 0")
def _(v):
    pieces = v("assets_v").withColumn("asset_key", F.when(F.col("asset_key") == "SCL_20m", "CLD_20m").otherwise(F.col("asset_key")))
    return grid.chosen_nodata(pieces)


@q("r10_promotion", "SELECT item_id, CASE WHEN bool_or(data_type = 'UInt16') AND bool_or(data_type = 'Int16') THEN 'Int32' WHEN bool_or(data_type = 'UInt16') THEN 'UInt16' WHEN bool_or(data_type = 'Int16') THEN 'Int16' ELSE 'Byte' END AS type FROM assets_v GROUP BY 1")
def _(v):
    return v("assets_v").groupBy("item_id").agg(F.collect_set("data_type").alias("t")).select("item_id", grid.promoted_type(F.col("t")).alias("type"))


@q("r11_target_grid", "SELECT CAST(3857 AS BIGINT) AS epsg, min(resolution_m) AS resolution_m FROM assets_v")
def _(v):
    return grid.target_grid(v("assets_v")).select(F.col("epsg").cast("long").alias("epsg"), "resolution_m")


@q("r12_size_guard", "SELECT item_id FROM items_v WHERE CAST(area AS DOUBLE) // 100000000 * 8 <= 25000")
def _(v):
    requests = v("items_v").select("item_id", F.floor(F.col("area") / 100000000).alias("width"), F.lit(1).alias("height"), F.lit(2).alias("bands"), F.lit(4).alias("bytes_each"))
    return grid.within_limit(requests, 25000)[0].select("item_id")


@q("u01_upsert", """
WITH n AS (SELECT item_id, count(*) AS n FROM attempts_v GROUP BY 1)
SELECT coalesce(j.item_id, n.item_id) AS item_id, CASE WHEN n.item_id IS NOT NULL THEN 'seen' ELSE j.status END AS status, CAST(CASE WHEN j.item_id IS NULL THEN n.n ELSE j.attempts END AS BIGINT) AS attempts FROM jobs_v j FULL JOIN n ON n.item_id = j.item_id""")
def _(v):
    old = v("jobs_v").select("item_id", "status", F.col("attempts").cast("long").alias("attempts"))
    new = v("attempts_v").groupBy("item_id").agg(F.lit("seen").alias("status"), F.count(F.lit(1)).alias("attempts"))
    return upserts.upsert(old, new, ["item_id"], ["status"])


@q("u02_upsert_assets", """SELECT item_id, asset_key, CASE WHEN item_id % 3 = 0 THEN 'queued' ELSE status END AS status, CASE WHEN item_id % 3 = 0 THEN NULL ELSE bytes END AS bytes FROM assets_v""")
def _(v):
    a = v("assets_v")
    old = a.select("item_id", "asset_key", "href", "local_path", "status", F.lit(1).alias("attempts"), "bytes", F.lit("h").alias("sha256"), F.lit(None).cast("string").alias("last_error"))
    new = a.select("item_id", "asset_key", F.when(F.col("item_id") % 3 == 0, F.concat("href", F.lit("x"))).otherwise(F.col("href")).alias("href"), "local_path")
    return upserts.upsert_assets(old, new).select("item_id", "asset_key", "status", "bytes")


@q("u03_upsert_jobs", "SELECT item_id, CASE WHEN item_id % 4 = 0 THEN 'queued' ELSE status END AS status, CAST(CASE WHEN item_id % 4 = 0 THEN 0 ELSE attempts END AS INT) AS attempts, item_id % 4 = 0 AS changed FROM jobs_v")
def _(v):
    lists = {"requested_assets": F.array(F.lit("a"), F.lit("b")), "missing_assets": F.array().cast("array<string>")}
    old = v("jobs_v").withColumns(lists | {"last_error": F.lit(None).cast("string")})
    new = old.withColumn("requested_assets", F.when(F.col("item_id") % 4 == 0, F.array(F.lit("c"))).otherwise(F.array(F.lit("b"), F.lit("a"), F.lit("b"))))
    return upserts.upsert_jobs(old, new).select("item_id", "status", "attempts", "changed")


@q("u04_retain_selected", "SELECT item_id, asset_key, CASE WHEN item_id % 2 = 0 AND asset_key NOT LIKE '%10m' THEN 'unselected' ELSE status END AS status FROM assets_v")
def _(v):
    a = v("assets_v").select("item_id", "asset_key", "status")
    touched = a.filter("item_id % 2 = 0")
    return upserts.retain_selected(a, touched.filter("asset_key like '%10m'"), touched)[1]


@q("u05_sync_status", "SELECT i.item_id, coalesce(j.status, i.status) AS status FROM items_v i LEFT JOIN (SELECT * FROM jobs_v WHERE item_id % 2 = 0) j USING (item_id)")
def _(v):
    return upserts.sync_status(v("items_v").select("item_id", "status"), v("jobs_v").filter("item_id % 2 = 0"), ["item_id"], ["status"])


@q("u06_enrich_rasters", "SELECT item_id, asset_key, CASE WHEN local_path IS NOT NULL AND item_id % 2 = 0 THEN 4326 ELSE epsg END AS epsg, CASE WHEN local_path IS NOT NULL THEN 'GTiff' END AS driver FROM assets_v")
def _(v):
    a = v("assets_v").withColumns({"driver": F.lit(None).cast("string"), "raster_dtype": F.lit(None).cast("string"), "width": F.lit(None).cast("int"), "height": F.lit(None).cast("int")})
    headers = a.filter("local_path is not null").select("local_path", F.lit("GTiff").alias("driver"), F.lit("UInt16").alias("raster_dtype"), F.lit(1).alias("width"), F.lit(1).alias("height"), F.when(F.col("item_id") % 2 == 0, F.lit(4326).cast("long")).alias("epsg"))
    return upserts.enrich_rasters(a, headers).select("item_id", "asset_key", "epsg", "driver")


@q("u07_run_ledger", "SELECT 'db' AS state_db, item_id AS run_id, CASE WHEN status = 'processing' THEN 'complete' ELSE status END AS status FROM jobs_v")
def _(v):
    old = v("jobs_v").select(F.lit("db").alias("state_db"), F.col("item_id").alias("run_id"), "status")
    return upserts.upsert_runs(old, old.filter("status = 'processing'").withColumn("status", F.lit("complete")))


@q("u08_replace_images", "SELECT item_id, asset_key AS image_type FROM assets_v WHERE asset_key = 'B03_10m' OR item_id % 2 = 1 UNION ALL SELECT DISTINCT item_id, 'BOA' FROM assets_v WHERE item_id % 2 = 0")
def _(v):
    images = v("assets_v").select("item_id", F.col("asset_key").alias("image_type"))
    new = images.filter("item_id % 2 = 0").select("item_id", F.lit("BOA").alias("image_type")).distinct()
    return upserts.replace_images(images, new, "B03_10m")


@q("u09_repair", "SELECT item_id, asset_key, CASE WHEN item_id % 3 = 0 THEN 'missing' ELSE 'size-mismatch' END AS reason FROM assets_v WHERE status = 'completed' AND local_path IS NOT NULL AND item_id % 3 < 2 UNION ALL SELECT item_id, asset_key, 'missing' FROM assets_v WHERE status = 'completed' AND local_path IS NULL")
def _(v):
    a = v("assets_v")
    inventory = a.filter("local_path is not null and item_id % 3 > 0").select(F.col("local_path").alias("path"), (F.col("bytes") + F.when(F.col("item_id") % 3 == 1, 1).otherwise(0)).alias("length"))
    return upserts.assets_to_repair(a, inventory).select("item_id", "asset_key", "reason")


@q("u10_recover", "SELECT item_id, CASE WHEN status IN ('processing', 'failed', 'retired') THEN 'queued' ELSE status END AS status, CASE WHEN status IN ('failed', 'retired') THEN 0 ELSE attempts END AS attempts FROM jobs_v")
def _(v):
    jobs = upserts.recover_interrupted(v("jobs_v"))
    return upserts.requeue_terminal(jobs, v("assets_v").select("item_id", "asset_key", "status", F.lit(1).alias("attempts")))[0].select("item_id", "status", "attempts")


@q("t01_incremental", f"SELECT item_id, {at('min(ts)')} AS first_seen, count(*) - 1 AS dropped FROM attempts_v WHERE ts >= TIMESTAMP '2024-01-20' - INTERVAL 72 HOUR AND ts <= TIMESTAMP '2024-01-28' GROUP BY 1")
def _(v):
    from datetime import datetime

    start, _ = state.discovery_window(datetime(2024, 1, 20), datetime(2024, 1, 28))
    seen = v("attempts_v").filter(p.in_time_range("ts", start, datetime(2024, 1, 28)))
    return seen.groupBy("item_id").agg(F.min("ts").alias("first_seen"), (F.count(F.lit(1)) - 1).alias("dropped")).select("item_id", ts("first_seen"), "dropped")


@q("t02_high_water", f"SELECT {at('max(item_datetime)')} AS mark, count(DISTINCT item_id) AS items FROM jobs_v")
def _(v):
    return state.high_water_mark(v("jobs_v")).select(ts("mark"), "items")


def attempt_states(bad: str) -> str:
    """Each item's state after its last attempt that counts, of the rows where ``bad`` holds in the end."""
    return f"""
WITH e AS (SELECT *, outcome IN ('error', 'throttled') AS bad, coalesce(count(*) FILTER (outcome IN ('error', 'throttled')) OVER w, 0) AS earlier, coalesce(count(*) FILTER (outcome = 'completed') OVER w, 0) AS done
 FROM attempts_v WINDOW w AS (PARTITION BY item_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
l AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY event_id DESC) AS back FROM e WHERE earlier < 5 AND done = 0),
s AS (SELECT item_id, CASE WHEN outcome = 'completed' THEN 'completed' WHEN bad AND earlier = 4 THEN CASE outcome WHEN 'throttled' THEN 'retired' ELSE 'failed' END WHEN bad THEN 'retry_wait' ELSE 'queued' END AS status,
 CAST(earlier + CASE WHEN bad THEN 1 ELSE 0 END AS INT) AS attempts, event_id AS last_event,
 CASE WHEN bad AND earlier < 4 THEN {at("ts + to_microseconds(CAST(1e6 * CASE outcome WHEN 'throttled' THEN coalesce(retry_after, 900) ELSE least(3600, 60 * pow(2, earlier)) END AS BIGINT))")} END AS next_attempt_at FROM l WHERE back = 1)
SELECT item_id, status, attempts, next_attempt_at{", last_event" if bad == "TRUE" else ""} FROM s WHERE {bad}"""


@q("t04_fold_attempts", attempt_states("TRUE"))
def _(v):
    return state.fold_attempts(v("attempts_v")).select("item_id", "status", "attempts", ts("next_attempt_at"), "last_event")


#: State of jobs and their three assets (status and attempts, null before they are known), one event of every item a turn.
JOB_STATES = f"""
WITH RECURSIVE e AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY event_id) AS nth, CAST(asset_key[2] AS INT) + 1 AS k FROM job_events_v),
s(item_id, nth, last_event, status, attempts, due, sa, na) AS (
 SELECT DISTINCT item_id, CAST(0 AS BIGINT), CAST(NULL AS BIGINT), 'queued', 0, CAST(NULL AS TIMESTAMP), CAST([NULL, NULL, NULL] AS VARCHAR[]), CAST([0, 0, 0] AS INT[]) FROM e
 UNION ALL
 SELECT item_id, nth, event_id,
  CASE WHEN reg AND status = 'completed' THEN 'queued' WHEN cl THEN 'processing' WHEN rs OR (hit AND kind = 'interrupted') THEN 'queued' WHEN bad AND over THEN CASE kind WHEN 'error' THEN 'failed' ELSE 'retired' END WHEN bad THEN 'retry_wait'
   WHEN hit AND kind = 'completed' AND len(list_filter(sb, lambda x: x <> 'completed')) = 0 THEN 'completed' ELSE status END,
  CASE WHEN bad THEN attempts + 1 ELSE attempts END,
  CASE WHEN cl OR (hit AND kind = 'interrupted') OR (bad AND over) THEN NULL WHEN bad THEN ts + to_microseconds(CAST(1e6 * CASE kind WHEN 'throttled' THEN coalesce(retry_after, 900) ELSE least(3600, 60 * pow(2, attempts)) END AS BIGINT)) ELSE due END, sb,
  CASE WHEN bad THEN list_transform(na, lambda x, i: x + CASE WHEN i = k THEN 1 ELSE 0 END) ELSE na END
 FROM (SELECT *, CASE WHEN rs THEN list_transform(sa, lambda x: CASE WHEN x = 'processing' THEN 'queued' ELSE x END)
   WHEN reg OR hit THEN list_transform(sa, lambda x, i: CASE WHEN i <> k THEN x WHEN reg OR kind = 'interrupted' THEN 'queued' WHEN kind = 'completed' OR (kind = 'start' AND x = 'completed') THEN 'completed' WHEN kind = 'start' THEN 'processing' WHEN kind = 'throttled' AND over THEN 'retired' ELSE 'retry_wait' END) ELSE sa END AS sb
  FROM (SELECT *, live AND kind = 'asset' AND coalesce(k > 0 AND sa[k] IS NULL, FALSE) AS reg, live AND coalesce(kind = 'claim', FALSE) AND status IN ('queued', 'retry_wait') AS cl, coalesce(kind = 'restart', FALSE) AND status = 'processing' AS rs,
    status = 'processing' AND coalesce(sa[k] IS NOT NULL AND kind IN ('start', 'completed', 'interrupted', 'error', 'throttled'), FALSE) AS hit, status = 'processing' AND coalesce(sa[k] IS NOT NULL AND kind IN ('error', 'throttled'), FALSE) AS bad, attempts + 1 >= 5 AS over
   FROM (SELECT e.item_id, e.nth, e.event_id, e.ts, coalesce(e.kind, '') AS kind, e.k, e.retry_after, s.status, s.attempts, s.due, s.sa, s.na, s.status NOT IN ('failed', 'retired') AS live FROM s JOIN e ON e.item_id = s.item_id AND e.nth = s.nth + 1) x) y) z),
f AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY nth DESC) = 1)"""


@q("t04_job_assets", f"""{JOB_STATES},
a AS (SELECT item_id, last_event, unnest(['a0', 'a1', 'a2']) AS asset_key, unnest(sa) AS status, unnest(na) AS attempts FROM f)
SELECT item_id, NULL AS asset_key, status, attempts, {at("due")} AS next_attempt_at, last_event FROM f UNION ALL SELECT item_id, asset_key, status, attempts, NULL, last_event FROM a WHERE status IS NOT NULL""")
def _(v):
    return jobs.fold_job_events(v("job_events_v")).select("item_id", "asset_key", "status", "attempts", ts("next_attempt_at"), "last_event")


@q("t05_due_retries", f"""{JOB_STATES}
SELECT item_id, attempts, {at("due")} AS next_attempt_at FROM f WHERE status = 'retry_wait' AND due <= (SELECT max(ts) FROM job_events_v)""")
def _(v):
    events = v("job_events_v")
    now = events.agg(F.max("ts")).first()[0]
    return jobs.due_retries(jobs.fold_job_events(events), F.lit(now)).select("item_id", "attempts", ts("next_attempt_at"))


@q("t06_window_status", """
WITH w AS (SELECT CAST((epoch_us(item_datetime) - epoch_us(TIMESTAMP '1992-01-01')) // (7 * 86400000000) AS INT) AS "window", status FROM jobs_v WHERE item_datetime >= TIMESTAMP '1992-01-01'),
c AS (SELECT "window", count(*) FILTER (status IN ('queued', 'processing', 'retry_wait')) AS active, count(*) FILTER (status = 'completed') AS completed, count(*) FILTER (status = 'retired') AS retired FROM w GROUP BY 1)
SELECT "window", completed, retired, CASE WHEN active > 0 THEN 'active' WHEN retired > 0 THEN 'complete_with_retired' ELSE 'complete' END AS state FROM c""")
def _(v):
    return state.windowed_status(v("jobs_v"), "1992-01-01", 7).select("window", "completed", "retired", "state")


@q("t07_progress", """
WITH w AS (SELECT CAST((epoch_us(item_datetime) - epoch_us(TIMESTAMP '1992-01-01')) // (7 * 86400000000) AS INT) AS "window", count(*) FILTER (status IN ('queued', 'processing', 'retry_wait')) AS active FROM jobs_v WHERE item_datetime >= TIMESTAMP '1992-01-01' GROUP BY 1)
SELECT CAST(coalesce(min("window") FILTER (active > 0), 400) AS INT) AS "cursor", count(*) FILTER (active = 0) AS done, 400 AS total FROM w""")
def _(v):
    return state.backfill_progress(state.windowed_status(v("jobs_v"), "1992-01-01", 7), 400)


@q("t11_run_counts", """
WITH s AS (SELECT l_orderkey % 50 AS run_id, l_orderkey AS item_id, l_linenumber % 4 AS stage, max(CASE WHEN l_suppkey % 9 = 0 THEN 'failed' WHEN l_suppkey % 9 = 1 THEN 'skipped' ELSE 'ok' END) AS outcome FROM lineitem GROUP BY 1, 2, 3),
l AS (SELECT run_id, item_id, max_by(outcome, stage) AS last, max(stage) AS stage, bool_and(outcome = 'skipped') AS sk, count(*) FILTER (stage = 0 AND outcome = 'ok') AS down FROM s GROUP BY 1, 2)
SELECT run_id, CAST(sum(down) AS BIGINT) AS downloaded, count(*) FILTER (NOT sk AND last <> 'failed' AND stage = 3) AS processed, count(*) FILTER (sk) AS skipped, count(*) FILTER (NOT sk AND last <> 'failed' AND stage < 3) AS "partial", count(*) FILTER (NOT sk AND last = 'failed') AS failed FROM l GROUP BY 1""")
def _(v):
    outcome = F.when(F.col("l_suppkey") % 9 == 0, "failed").when(F.col("l_suppkey") % 9 == 1, "skipped").otherwise("ok")
    stages = v("lineitem").select((F.col("l_orderkey") % 50).alias("run_id"), F.col("l_orderkey").alias("item_id"), (F.col("l_linenumber") % 4).alias("stage"), outcome.alias("outcome")).groupBy("run_id", "item_id", "stage").agg(F.max("outcome").alias("outcome"))
    return audit.run_counts(stages)


RINGS = "array(array(array(west, south), array(east, south), array(east, north), array(west, north), array(west, south)))"


def shapes(v) -> DataFrame:
    outer = [("west", "south"), ("east", "south"), ("east", "north"), ("west", "north"), ("west", "south")]
    ring = F.array(*(F.array((F.col(x) / 1e6), (F.col(y) / 1e6)) for x, y in outer))
    hole = F.array(*(F.array((F.col("west") + x * 100000) / 1e6, (F.col("south") + y * 100000) / 1e6) for x, y in ((1, 1), (2, 1), (2, 2), (1, 2), (1, 1))))
    return v("items_v").withColumn("polygons", F.array(F.array(ring, hole)))


@q("f01_area", "SELECT item_id, round(area / 1e12 - 0.01, 6) AS area FROM items_v")
def _(v):
    return shapes(v).select("item_id", F.round(s.geometry_area(F.col("polygons")), 6).alias("area"))


@q("f02_geometry", "SELECT item_id, round(west / 1e6, 6) AS west, round(north / 1e6, 6) AS north, true AS valid FROM items_v")
def _(v):
    g = shapes(v).withColumn("b", s.geometry_bbox(F.col("polygons")))
    return g.select("item_id", F.round("b.west", 6).alias("west"), F.round("b.north", 6).alias("north"), s.valid_geometry(F.col("polygons")).alias("valid"))


@q("f03_bbox_around", "SELECT item_id, round(west / 1e6 - 500 / (111320.0e0 * cos(radians(south / 1e6))), 6) AS west, round(south / 1e6 + 250 / 111320.0e0, 6) AS north FROM items_v")
def _(v):
    box = s.bbox_around(F.col("west") / 1e6, F.col("south") / 1e6, F.lit(1000.0), F.lit(500.0))
    return v("items_v").select("item_id", box.alias("b")).select("item_id", F.round("b.west", 6).alias("west"), F.round("b.north", 6).alias("north"))


@q("f04_edge_points", "SELECT item_id, CAST(84 AS INT) AS n, round(west / 1e6, 6) AS west, round(east / 1e6, 6) AS east FROM items_v")
def _(v):
    pts = s.edge_points(*(F.col(c) / 1e6 for c in ("west", "south", "east", "north")))
    e = v("items_v").select("item_id", F.size(pts).alias("n"), s.envelope(pts).alias("e"))
    return e.select("item_id", "n", F.round("e.west", 6).alias("west"), F.round("e.east", 6).alias("east"))


@q("f05_raster_extent", "SELECT item_id, CASE WHEN item_id % 5 = 0 THEN NULL ELSE round(west + 10.0e0 * 100, 6) END AS east, CASE WHEN item_id % 5 = 0 THEN NULL ELSE round(north - 10.0e0 * 50, 6) END AS south FROM items_v")
def _(v):
    skew = F.when(F.col("item_id") % 5 == 0, 0.1).otherwise(0.0)
    ext = s.raster_extent(F.col("west").cast("double"), F.lit(10.0), skew, F.col("north").cast("double"), F.lit(0.0), F.lit(-10.0), F.lit(100), F.lit(50))
    return v("items_v").select("item_id", ext.alias("e")).select("item_id", F.round("e.east", 6).alias("east"), F.round("e.south", 6).alias("south"))


@q("f06_mercator", "SELECT item_id, round(ln(tan(pi() / 4 + radians(least(greatest(south / 5e5, -85.05112878), 85.05112878)) / 2)), 6) AS y FROM items_v")
def _(v):
    return v("items_v").select("item_id", F.round(s.mercator_y(F.col("south") / 5e5), 6).alias("y"))


@q("f07_parse_time", "SELECT item_id, CASE WHEN item_id % 2 = 0 THEN strftime(CAST(CAST(acquired AS DATE) AS TIMESTAMP) + INTERVAL 1 DAY, '%Y-%m-%d %H:%M:%S') ELSE strftime(acquired, '%Y-%m-%d %H:%M:%S') END AS t FROM items_v")
def _(v):
    text = F.when(F.col("item_id") % 2 == 0, F.date_format("acquired", "yyyy-MM-dd")).otherwise(s.iso_z(F.col("acquired")))
    return v("items_v").select("item_id", s.parse_time(text, True).alias("t")).select("item_id", ts("t"))


@q("f08_iso_text", "SELECT item_id, strftime(acquired, '%Y-%m-%dT%H:%M:%SZ') || '/..' AS t FROM items_v")
def _(v):
    return v("items_v").select("item_id", s.interval_text(F.col("acquired"), F.lit(None).cast("timestamp")).alias("t"))


@q("f09_checksum", "SELECT item_id, CASE item_id % 4 WHEN 3 THEN NULL ELSE sha256(CAST(item_id AS VARCHAR)) END AS checksum FROM items_v")
def _(v):
    h, k = F.sha2(F.col("item_id").cast("string").cast("binary"), 256), F.col("item_id") % 4
    text = F.when(k == 0, F.concat(F.lit("sha256:"), h)).when(k == 1, F.concat(F.lit("1220"), F.upper(h))).when(k == 2, h).otherwise(F.lit("bad"))
    return v("items_v").select("item_id", s.normal_checksum(text).alias("checksum"))


@q("f10_safe_names", "SELECT item_id, asset_key, CASE WHEN local_path IS NULL THEN 'unknown' ELSE replace(local_path, '/', '_') END AS name, CASE WHEN href LIKE '%.jp2' THEN '.jp2' WHEN href LIKE '%.TIF' THEN '.TIF' WHEN href LIKE '%.json' THEN '.json' ELSE '.bin' END AS suffix FROM assets_v")
def _(v):
    return v("assets_v").select("item_id", "asset_key", s.safe_component(F.col("local_path")).alias("name"), s.safe_suffix(F.col("href")).alias("suffix"))


@q("f11_retry_delay", "SELECT item_id, least(3600.0e0, 60.0e0 * pow(2, attempts)) AS delay FROM jobs_v")
def _(v):
    return v("jobs_v").select("item_id", s.retry_delay(F.col("attempts")).alias("delay"))


@q("f12_json", "SELECT event_id, json_extract_string(props, '$.k') AS k FROM events")
def _(v):
    return v("events").select("event_id", F.get_json_object(F.to_json(F.from_json("props", "map<string,string>")), "$.k").alias("k"))


@q("f13_s3_uri", "SELECT item_id, asset_key, 'bucket' || item_id % 3 AS bucket, substr(href, 14) AS key FROM assets_v")
def _(v):
    return v("assets_v").select("item_id", "asset_key", s.s3_parts(F.col("href")).alias("u")).select("item_id", "asset_key", "u.bucket", "u.key")


@q("f15_fingerprint", "SELECT item_id, sha256('{\"attempts\":' || attempts || ',\"status\":\"' || status || '\"}') AS fingerprint FROM jobs_v")
def _(v):
    return v("jobs_v").select("item_id", s.fingerprint("status", "attempts").alias("fingerprint"))


@q("o03_max_items", "SELECT item_id FROM (SELECT * FROM items_v ORDER BY acquired, item_id LIMIT 200) WHERE cloud_cover IS NULL OR cloud_cover <= 50")
def _(v):
    return catalog.search_items(v("items_v"), max_cloud=50, max_items=200).select("item_id")


EARLY = "(SELECT * FROM items_v WHERE acquired < TIMESTAMP '1996-01-01')"


@q("t03_bootstrap_then_follow", f"""
WITH b AS ({LATEST.format(t=EARLY, o='acquired DESC, published DESC, item_id DESC')}), ig AS (SELECT item_id FROM {EARLY} ANTI JOIN b USING (item_id))
SELECT item_id FROM items_v ANTI JOIN ig USING (item_id) WHERE acquired >= TIMESTAMP '1995-12-29'""")
def _(v):
    items = v("items_v")
    ignored = selection.bootstrap(items.filter("acquired < timestamp'1996-01-01'"))[1]
    return selection.new_items(items.filter("acquired >= timestamp'1995-12-29'"), ignored).select("item_id")


@q("t08_late_entries", "SELECT i.item_id FROM items_v i ANTI JOIN (SELECT item_id FROM jobs_v WHERE item_datetime < TIMESTAMP '1996-01-01') j USING (item_id) WHERE acquired >= TIMESTAMP '1995-12-29'")
def _(v):
    known = v("jobs_v").filter("item_datetime < timestamp'1996-01-01'")
    return selection.new_items(v("items_v").filter("acquired >= timestamp'1995-12-29'"), known).select("item_id")
