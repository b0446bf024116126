"""Queries that write a table, document or file and read it back: scans and sinks (S), state kept by streams (T), availability."""

from __future__ import annotations

from pyspark.sql import functions as F

from orbitgrain.functions import predicates as p
from orbitgrain.operators import blocks as tiled
from orbitgrain.operators import catalog, composite, inventories, selection, state
from orbitgrain.plans.catalog_queries import SEVEN, attempt_states, ts
from orbitgrain.plans.pixel_queries import cells_of, NAMES, QAI, index_sql, later, round_sql, rounded, screened
from orbitgrain.plans.registry import at, q
from orbitgrain.session import scratch_path
from orbitgrain.sources import sinks, stac
from orbitgrain.streaming import commits, ingest


@q("s01_stac_items", """
WITH a AS (SELECT item_id, count(*) AS n FROM assets_v GROUP BY 1),
k AS (SELECT *, CASE WHEN item_id % 97 = 0 THEN 'not-json' WHEN item_id % 89 = 0 THEN 'no-id' ELSE 'item' END AS kind FROM items_v LEFT JOIN a USING (item_id))
SELECT kind, CASE WHEN kind = 'item' THEN 'i' || item_id END AS id, CASE WHEN kind = 'item' THEN collection_id END AS collection, CASE WHEN kind = 'item' THEN west / 1e6 END AS west, CASE WHEN kind = 'item' THEN coalesce(n, 0) END AS n_assets FROM k""")
def _(v):
    links = v("assets_v").groupBy("item_id").agg(F.map_from_entries(F.collect_list(F.struct("asset_key", F.struct("href", F.col("media").alias("type"))))).alias("assets"))
    items = v("items_v").join(links, "item_id", "left")
    document = F.struct(
        F.when(F.col("item_id") % 89 != 0, F.concat(F.lit("i"), F.col("item_id").cast("string"))).alias("id"), F.col("collection_id").alias("collection"),
        F.array(*(F.col(c) / 1e6 for c in ("west", "south", "east", "north"))).alias("bbox"), F.struct("cloud_cover", "platform").alias("properties"), "assets",
    )
    text = F.to_json(document)
    broken = F.expr("substring(value, 1, length(value) - 3)")
    path = scratch_path(items.sparkSession, "items")
    items.select("item_id", text.alias("value")).select(F.when(F.col("item_id") % 97 == 0, broken).otherwise(F.col("value"))).write.text(path)
    good, bad = stac.read_stac_items(items.sparkSession, path, lines=True, files="*.txt")
    found = good.select(F.lit("item").alias("kind"), "id", "collection", F.get("bbox", 0).alias("west"), F.coalesce(F.cardinality("assets"), F.lit(0)).cast("long").alias("n_assets"))
    return found.unionByName(bad.select(F.col("reason").alias("kind")), allowMissingColumns=True)


@q("s05_partitioned_items", """
SELECT item_id, collection_id AS collection, CAST(year(d) AS INT) AS year, CAST(month(d) AS INT) AS month, CAST(day(d) AS INT) AS day, CAST(tile_id % 2 AS INT) AS tile
FROM (SELECT *, date_trunc('quarter', acquired) AS d FROM items_v) x""")
def _(v):
    items = v("items_v").withColumns({"acquired": F.date_trunc("quarter", "acquired"), "tile_id": F.col("tile_id") % 2})
    path = scratch_path(items.sparkSession, "partitioned")
    sinks.write_items(items, path)
    return items.sparkSession.read.parquet(path).select("item_id", "collection", "year", "month", "day", "tile")


@q("s07_inventory", """
WITH g AS (SELECT collection_id, orbit, collection_id || ',' || orbit || ',' || count(*) || ',' || sum(item_id) || chr(10) AS t FROM items_v GROUP BY 1, 2)
SELECT left(collection_id, 1) AS collection, CAST(orbit AS INT) AS orbit, CAST(length(t) AS BIGINT) AS length, sha256(t) AS sha256 FROM g""")
def _(v):
    keys = ("collection_id", "orbit")
    sums = v("items_v").groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.sum("item_id").alias("s"))
    path = scratch_path(sums.sparkSession, "inventory")
    sums.select(*keys, F.concat_ws(",", *keys, "n", "s").alias("value")).write.partitionBy(*keys).text(path)
    files = stac.read_inventory(sums.sparkSession, path)
    part = lambda name: F.regexp_extract("path", f"{name}=([^/]*)", 1)
    return files.select(F.left(part("collection_id"), F.lit(1)).alias("collection"), part("orbit").cast("int").alias("orbit"), "length", "sha256")


@q("s08_regions", """
WITH b AS (SELECT item_id, west / 1e6 AS w, south / 1e6 AS s, east / 1e6 AS e, north / 1e6 AS n, item_id % 11 = 0 AS point FROM items_v),
r AS (SELECT *, '[[[' || w || ',' || s || '],[' || e || ',' || s || '],[' || e || ',' || n || '],[' || w || ',' || n || '],[' || w || ',' || s || ']]]' AS ring FROM b)
SELECT item_id, CASE WHEN NOT point THEN w END AS west, CASE WHEN NOT point THEN s END AS south, CASE WHEN NOT point THEN e END AS east, CASE WHEN NOT point THEN n END AS north, NOT point AS valid,
 CASE WHEN NOT point THEN sha256('[' || ring || CASE WHEN item_id % 3 = 2 THEN ',' || ring ELSE '' END || ']') END AS fingerprint FROM r""")
def _(v):
    at_ = {k: (F.col(c) / 1e6).cast("string") for k, c in (("w", "west"), ("s", "south"), ("e", "east"), ("n", "north"))}
    corner = lambda a, b: F.concat(F.lit("["), F.col(a), F.lit(","), F.col(b), F.lit("]"))
    ring = F.concat(F.lit("[["), F.concat_ws(",", corner("w", "s"), corner("e", "s"), corner("e", "n"), corner("w", "n"), corner("w", "s")), F.lit("]]"))
    kind = F.when(F.col("item_id") % 11 == 0, "Point").otherwise("Polygon")
    geometry = F.concat(F.lit('{"type":"'), kind, F.lit('","coordinates":'), F.when(kind == "Point", F.lit("[7.0,46.0]")).otherwise(ring), F.lit("}"))
    feature = F.concat(F.lit('{"type":"Feature","geometry":'), geometry, F.lit("}"))
    both = F.concat(F.lit('{"type":"FeatureCollection","features":['), feature, F.lit(","), feature, F.lit("]}"))
    text = F.when(F.col("item_id") % 3 == 0, geometry).when(F.col("item_id") % 3 == 1, feature).otherwise(both)
    regions = stac.regions_from_json(v("items_v").withColumns(at_).select(F.col("item_id").alias("roi_id"), text.alias("value")))
    return regions.select(F.col("roi_id").alias("item_id"), "west", "south", "east", "north", "valid", F.when(F.col("valid"), F.col("fingerprint")).alias("fingerprint"))


MED = ", ".join(f"median({b}) AS {b}" for b in NAMES)


@q("s10_month_product", f"""
WITH s AS (SELECT cx, cy, {screened(QAI, '0.0001e0')} FROM pixels_v WHERE source = 'boa' AND acquired >= TIMESTAMP '1998-06-01' AND acquired < TIMESTAMP '1998-07-01'),
f AS (SELECT cx, cy, {MED} FROM s GROUP BY 1, 2) SELECT cx, cy, {round_sql()}, {index_sql()} FROM f""")
def _(v):
    cells = composite.qai_composite(later(v).filter("source = 'boa'"), 2015, 6)
    spark = cells.sparkSession
    return rounded(spark.read.parquet(sinks.write_month(cells, scratch_path(spark, "products"), "boa", 2015, 6, 10)))


@q("s11_manifests", """
WITH x AS (SELECT 't' || tile_id || '-' || strftime(acquired, '%Y-%m') AS product, item_id, cloud_cover, coalesce(cloud_cover <= 60, TRUE) AS used FROM items_v)
SELECT product, count(*) FILTER (used) AS scene_count, round(avg(cloud_cover) FILTER (used), 6) AS mean_cloud, coalesce(string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY item_id) FILTER (used), '') AS inputs,
 coalesce(string_agg(item_id || ':cloud-cover', ',' ORDER BY item_id) FILTER (NOT used), '') AS skipped, 'cloud60' AS quality_rule FROM x GROUP BY 1""")
def _(v):
    used = p.cloud_at_most(60)
    product = F.concat(F.lit("t"), F.col("tile_id").cast("string"), F.lit("-"), F.date_format("acquired", "yyyy-MM"))
    inputs = v("items_v").select(product.alias("product"), "item_id", "cloud_cover", used.alias("selected"), F.when(~used, F.array(F.lit("cloud-cover"))).otherwise(F.array().cast("array<string>")).alias("reasons"))
    rows = sinks.manifests(inputs, "cloud60", {"total": 1.0})
    path = scratch_path(inputs.sparkSession, "manifests")
    sinks.write_manifest(rows, path)
    back = inputs.sparkSession.read.schema(rows.schema).json(path)
    skipped = F.transform("skipped", lambda s: F.concat_ws(":", s["item_id"].cast("string"), F.array_join(s["reasons"], "+")))
    return back.select("product", "scene_count", F.round("mean_cloud", 6).alias("mean_cloud"), F.array_join(F.col("inputs").cast("array<string>"), ",").alias("inputs"), F.array_join(skipped, ",").alias("skipped"), "quality_rule")


@q("s12_composite_items", """
SELECT 't' || tile_id || '-' || strftime(m, '%Y-%m') AS id, strftime(m, '%Y-%m-%dT00:00:00Z') AS start_datetime, strftime(last_day(m), '%Y-%m-%dT23:59:59.999999Z') AS end_datetime, n AS scene_count, w AS west, FALSE AS provisional
FROM (SELECT tile_id, date_trunc('month', acquired) AS m, count(*) AS n, min(west) / 1e6 AS w FROM items_v GROUP BY 1, 2) x""")
def _(v):
    month = v("items_v").groupBy("tile_id", F.year("acquired").alias("year"), F.month("acquired").alias("month")).agg(
        F.count(F.lit(1)).alias("scene_count"), *((f(c) / 1e6).alias(c) for f, c in ((F.min, "west"), (F.min, "south"), (F.max, "east"), (F.max, "north")))
    )
    product = F.format_string("t%d-%04d-%02d", "tile_id", "year", "month")
    features = sinks.composite_item(month.withColumns({"product": product, "gsd": F.lit(10)}))
    path = scratch_path(features.sparkSession, "features")
    features.write.text(path)
    back = features.sparkSession.read.text(path)
    member = lambda name: F.get_json_object("value", f"$.{name}")
    return back.select(
        member("id").alias("id"), *(member(f"properties.{c}").alias(c) for c in ("start_datetime", "end_datetime")), member("properties.scene_count").cast("long").alias("scene_count"),
        member("bbox[0]").cast("double").alias("west"), member("properties.provisional").cast("boolean").alias("provisional"),
    )


@q("s13_statistics", """
WITH l AS (SELECT source, CAST(year(acquired) * 100 + month(acquired) AS BIGINT) AS month, 'b04' AS "index", b04 AS v FROM pixels_v UNION ALL SELECT source, CAST(year(acquired) * 100 + month(acquired) AS BIGINT), 'b08', b08 FROM pixels_v)
SELECT source, month, "index", count(*) AS csv_n, min(v) AS csv_least, count(*) AS json_n, max(v) AS json_most FROM l GROUP BY 1, 2, 3""")
def _(v):
    long = v("pixels_v").select("source", (F.year("acquired").cast("long") * 100 + F.month("acquired")).alias("month"), F.explode(F.create_map(F.lit("b04"), F.col("b04"), F.lit("b08"), F.col("b08"))).alias("index", "v"))
    stats = long.groupBy("source", "month", "index").agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("least"), F.max("v").alias("most"))
    spark, path = stats.sparkSession, scratch_path(stats.sparkSession, "statistics")
    sinks.write_statistics(stats, path)
    table = spark.read.option("header", True).schema(stats.schema).csv(f"{path}/csv")
    nested = spark.read.schema("source string, month long, indices array<struct<index: string, n: long, least: long, most: long>>").json(f"{path}/json")
    opened = nested.select("source", "month", F.explode("indices").alias("i")).select("source", "month", "i.index", F.col("i.n").alias("json_n"), F.col("i.most").alias("json_most"))
    return table.select("source", "month", "index", F.col("n").alias("csv_n"), F.col("least").alias("csv_least")).join(opened, ["source", "month", "index"])


@q("p03_in_month", "SELECT item_id FROM items_v WHERE acquired >= TIMESTAMP '1998-06-01' AND acquired < TIMESTAMP '1998-07-01'")
def _(v):
    return v("items_v").withColumn("acquired", F.col("acquired") + F.make_ym_interval(F.lit(17))).filter(p.in_month("acquired", 2015, 6)).select("item_id")


@q("o01_in_order", f"SELECT {at('acquired')} AS acquired, tile_id, asset_key, item_id FROM items_v JOIN assets_v USING (item_id) ORDER BY 1, 2, 3, 4")
def _(v):
    return catalog.in_piece_order(v("items_v").join(v("assets_v").drop("status"), "item_id")).select(ts("acquired"), "tile_id", "asset_key", "item_id")


@q("t05_retry_schedule", attempt_states("status IN ('retry_wait', 'failed', 'retired')"))
def _(v):
    return state.fold_attempts(v("attempts_v")).filter(F.col("status").isin("retry_wait", "failed", "retired")).select("item_id", "status", "attempts", ts("next_attempt_at"))


@q("t09_requeue_changed", """
SELECT item_id, CASE WHEN item_id % 5 = 0 THEN 'v2/' WHEN item_id % 3 = 0 THEN 'v1/' ELSE 'v0/' END || item_id AS href, CAST(CASE WHEN item_id % 5 = 0 THEN 2 WHEN item_id % 3 = 0 THEN 1 ELSE 0 END AS BIGINT) AS batch_id,
 CASE WHEN item_id % 5 = 0 OR item_id % 3 = 0 THEN 'queued' ELSE 'completed' END AS status FROM items_v""")
def _(v):
    items = v("items_v").select("item_id")
    path = scratch_path(items.sparkSession, "latest")
    each = ingest.keep_latest(path)
    for batch, rule in ((0, "true"), (1, "item_id % 3 = 0"), (1, "item_id % 3 = 0"), (2, "item_id % 5 = 0")):  # one batch comes twice
        some = items.filter(rule)
        each(some.select("item_id", F.concat(F.lit(f"v{batch}/"), F.col("item_id").cast("string")).alias("href"), F.lit("queued" if batch else "completed").alias("status")), batch)
    return ingest.read_latest(items.sparkSession, path, ["item_id"]).select("item_id", "href", "batch_id", "status")


@q("t09_changed_sources", """
SELECT item_id, CASE WHEN item_id % 5 = 0 OR coalesce(n, 0) > 0 THEN 'queued' ELSE 'completed' END AS status, CASE WHEN item_id % 5 <> 0 AND n > 0 THEN 'a source changed' END AS last_error, coalesce(n, 0) AS queued_assets
FROM items_v LEFT JOIN (SELECT item_id, count(*) FILTER (item_id % 3 = 0 AND asset_key LIKE '%10m') AS n FROM assets_v GROUP BY 1) a USING (item_id)""")
def _(v):
    items, own = v("items_v"), v("assets_v").select("item_id", "asset_key", "href", "local_path")
    spark, path = items.sparkSession, scratch_path(items.sparkSession, "sources")
    assets, jobs = (commits.KeyedTable(spark, f"{path}/{name}", schema, "item_id", 8) for name, schema in (("assets", commits.ASSETS), ("jobs", commits.JOBS)))
    step = commits.requeue_changed(assets, jobs)
    seen = items.select("item_id", F.col("acquired").alias("item_datetime")).join(own, "item_id", "left").withColumns({"requested_assets": F.array(F.lit("a"), F.lit("b")), "missing_assets": F.array().cast("array<string>")})
    step(seen, 0)
    for t in (assets, jobs):  # all is fetched
        t.apply(t.read().select("item_id"), 1, lambda old, new: old.withColumn("status", F.lit("completed")))
    moved = seen.withColumn("href", F.when((F.col("item_id") % 3 == 0) & F.col("asset_key").like("%10m"), F.concat("href", F.lit("?v=2"))).otherwise(F.col("href")))
    moved = moved.withColumn("requested_assets", F.when(F.col("item_id") % 5 == 0, F.array(F.lit("c"))).otherwise(F.col("requested_assets")))
    for _ in range(2):  # the batch comes twice
        step(moved, 2)
    queued = assets.read().groupBy("item_id").agg(F.count_if(F.col("status") == "queued").alias("queued_assets"))
    return jobs.read().join(queued, "item_id", "left").select("item_id", "status", "last_error", F.coalesce("queued_assets", F.lit(0)).alias("queued_assets"))


@q("t06_logged_backfill", f"""
WITH w AS (SELECT CAST((epoch_us(item_datetime) - epoch_us(TIMESTAMP '1995-01-01')) // (30 * 86400000000) AS INT) AS n, count(*) AS jobs FROM jobs_v WHERE item_datetime >= TIMESTAMP '1995-01-01' AND item_datetime < TIMESTAMP '1995-06-30' GROUP BY 1)
SELECT {at("TIMESTAMP '1995-01-01' + to_days(CAST(30 * n AS INT))")} AS first, jobs FROM w""")
def _(v):
    from datetime import datetime

    jobs = v("jobs_v")
    spark, path = jobs.sparkSession, scratch_path(jobs.sparkSession, "backfill")

    def process(a, b):
        rows = jobs.filter(p.in_time_range("item_datetime", a, b, half_open=True)).agg(F.count(F.lit(1)).alias("jobs")).withColumn("first", F.lit(a).cast("timestamp"))
        rows.write.mode("overwrite").parquet(f"{path}/out/window={a:%Y%m%d}")
        return True

    plan = (spark, f"{path}/log", datetime(1995, 1, 1), datetime(1995, 6, 30), 30)
    calls = []
    commits.Backfill(*plan).run(lambda a, b: len(calls) < 2 and not calls.append(a) and process(a, b))  # stops after two windows
    commits.Backfill(*plan).run(process)
    return spark.read.parquet(f"{path}/out").filter("jobs > 0").select(ts("first"), "jobs")


@q("t10_resumed_tiles", "SELECT tile_id, count(*) AS pixels, CAST(sum(b04) AS BIGINT) AS b04, CASE WHEN tile_id % 2 = 0 THEN 'reused' ELSE 'made' END AS run FROM pixels_v GROUP BY 1, 4")
def _(v):
    px = v("pixels_v")
    spark, path = px.sparkSession, scratch_path(px.sparkSession, "tiles")
    log = commits.CommitLog(spark, f"{path}/log", "tile_id long, at timestamp")

    def product(run):
        return lambda source: source.groupBy("tile_id").agg(F.count(F.lit(1)).alias("pixels"), F.sum("b04").alias("b04")).withColumn("run", F.lit(run))

    commits.resume_tiles(px.filter("tile_id % 2 = 0"), log, f"{path}/out", product("reused"))
    return commits.resume_tiles(px, log, f"{path}/out", product("made"))


@q("p14_window_blocks", "SELECT item_id, cx, cy, round(CAST(CAST(avg(b04) AS FLOAT) AS DOUBLE), 3) AS b04 FROM pixels_v WHERE cx BETWEEN 4 AND 11 AND cy BETWEEN 2 AND 5 GROUP BY 1, 2, 3")
def _(v):
    px = v("pixels_v")
    path = scratch_path(px.sparkSession, "morton")
    tiled.write_blocks(composite.pixels_to_blocks(px, width=2, bands=("b04",)), path)
    return cells_of(tiled.read_window(px.sparkSession, path, 2, 1, 5, 2), 2, "item_id")


@q("j15_hash_tree", """
WITH f AS (SELECT strftime(acquired, '%Y-%m') AS month, strftime(acquired, '%d') AS day, 'p' || item_id % 3 AS product, 'f/' || item_id || '/' || asset_key AS path, item_id, day(acquired) AS d, month(acquired) AS m FROM assets_v JOIN items_v USING (item_id)),
k AS (SELECT *, CASE WHEN m = 3 AND d < 9 THEN CASE item_id % 7 WHEN 0 THEN 'missing' WHEN 1 THEN 'extra' WHEN 2 THEN 'size' WHEN 3 THEN 'hash' ELSE 'ok' END ELSE 'ok' END AS class FROM f)
SELECT month, day, product, path, class FROM k WHERE (month, day, product) IN (SELECT (month, day, product) FROM k WHERE class <> 'ok')""")
def _(v):
    files = v("assets_v").select("item_id", "asset_key", "bytes").join(v("items_v").select("item_id", "acquired"), "item_id")
    files = files.select("item_id", F.date_format("acquired", "yyyy-MM").alias("month"), F.date_format("acquired", "dd").alias("day"), F.concat(F.lit("p"), (F.col("item_id") % 3).cast("string")).alias("product"), F.concat_ws("/", F.lit("f"), F.col("item_id").cast("string"), "asset_key").alias("path"), F.col("bytes").alias("size"), F.lit("h").alias("sha256"), ((F.month("acquired") == 3) & (F.dayofmonth("acquired") < 9)).alias("hit"))
    k = F.when(F.col("hit"), F.col("item_id") % 7).otherwise(F.lit(6))
    path = scratch_path(files.sparkSession, "inventories")
    files.write.parquet(f"{path}/all")
    files = files.sparkSession.read.schema(files.schema).parquet(f"{path}/all")
    present = files.filter(k != 0).withColumns({"size": F.col("size") + F.when(k == 2, 1).otherwise(0), "sha256": F.when(k == 3, "g").otherwise("h")})
    for name, rows in (("expected", files.filter(k != 1)), ("present", present)):
        inventories.write_inventory(rows.drop("item_id", "hit"), f"{path}/{name}")
    return inventories.reconcile_inventories(files.sparkSession, f"{path}/expected", f"{path}/present")


KEYS = ", ".join(f"('{k}', {i})" for i, k in enumerate(SEVEN))


@q("x01_availability", f"""
WITH k(asset_key, place) AS (VALUES {KEYS}),
g AS (SELECT i.item_id, k.asset_key, k.place, a.item_id IS NOT NULL AS there, coalesce(a.bytes % 3000 <> 0 AND a.local_path IS NOT NULL, FALSE) AS readable FROM items_v i CROSS JOIN k LEFT JOIN assets_v a ON a.item_id = i.item_id AND a.asset_key = k.asset_key),
r AS (SELECT item_id, concat_ws(',', string_agg('missing:' || asset_key, ',' ORDER BY place) FILTER (NOT there), string_agg('missing-file:' || asset_key, ',' ORDER BY place) FILTER (there AND NOT readable)) AS reasons FROM g GROUP BY 1)
SELECT item_id, reasons, reasons = '' AS selected FROM r""")
def _(v):
    readable = (F.col("bytes") % 3000 != 0) & F.col("local_path").isNotNull()
    out = selection.complete_scenes(v("items_v"), v("assets_v"), SEVEN, available=readable)
    return out.select("item_id", F.array_join("reasons", ",").alias("reasons"), "selected")

