"""Catalogue, pixel and event tables as views of the given tables.

One text serves Spark and DuckDB: ``//`` is integer division (``div`` in
Spark), ``JSONK`` reads the member ``k`` of a JSON text, and ``{t}`` names a
given table.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

VIEWS = {
    "items_v": """
SELECT o_orderkey AS item_id, o_custkey % 100 AS tile_id, CAST(o_orderdate AS timestamp) AS acquired, o_orderpriority AS collection_id,
  CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE CAST(o_orderkey * 37 % 101 AS double) END AS cloud_cover,
  CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'queued' ELSE 'retry_wait' END AS status,
  5960000 + (o_custkey % 40) * 100000 AS west, 45820000 + ((o_custkey // 40) % 20) * 90000 AS south,
  5960000 + (o_custkey % 40) * 100000 + 500000 + (o_orderkey % 7) * 100000 AS east,
  45820000 + ((o_custkey // 40) % 20) * 90000 + 400000 + (o_orderkey % 5) * 100000 AS north,
  (500000 + (o_orderkey % 7) * 100000) * (400000 + (o_orderkey % 5) * 100000) AS area,
  CASE o_orderkey % 3 WHEN 0 THEN 'S2A' WHEN 1 THEN 'S2B' ELSE 'S2C' END AS platform, 400 + o_orderkey % 12 AS baseline,
  o_orderkey AS production, o_orderkey % 5 AS published, o_custkey % 13 AS orbit, o_totalprice AS price
FROM {orders}""",
    "assets_v": """
SELECT item_id, asset_key, bytes, CASE WHEN done = 'F' THEN 'completed' ELSE 'queued' END AS status,
  CASE WHEN bytes % 7000 = 0 THEN NULL ELSE 'f/' || CAST(item_id AS varchar(20)) || '/' || asset_key || '.tif' END AS local_path,
  's3://bucket' || CAST(item_id % 3 AS varchar(20)) || '/a/' || asset_key || CASE bytes % 4000 WHEN 0 THEN '.jp2' WHEN 1000 THEN '.TIF' WHEN 2000 THEN '.json' ELSE '' END AS href,
  CASE WHEN bytes % 5000 = 0 THEN 'image/jp2' WHEN bytes % 5000 = 1000 THEN 'application/json' ELSE NULL END AS media,
  CASE WHEN asset_key = 'SCL_20m' THEN 'Byte' WHEN bytes % 3000 = 0 THEN 'Int16' ELSE 'UInt16' END AS data_type,
  CASE WHEN asset_key = 'SCL_20m' THEN NULL ELSE 0.0e0 END AS nodata, 0.0001e0 AS raster_scale, CASE WHEN asset_key = 'B11_20m' AND bytes % 2000 = 0 THEN 0.0e0 ELSE -0.1e0 END AS raster_offset,
  32632 + item_id % 2 AS epsg, CASE WHEN asset_key LIKE '%10m' THEN 10 ELSE 20 END AS resolution_m
FROM (SELECT l_orderkey AS item_id, CASE l_linenumber WHEN 1 THEN 'B03_10m' WHEN 2 THEN 'B04_10m' WHEN 3 THEN 'B05_20m' WHEN 4 THEN 'B08_10m' WHEN 5 THEN 'B8A_20m' WHEN 6 THEN 'B11_20m' ELSE 'SCL_20m' END AS asset_key,
  max(l_partkey) * 1000 AS bytes, max(l_linestatus) AS done FROM {lineitem} GROUP BY 1, 2) AS a""",
    "pixels_v": """
SELECT l_orderkey AS item_id, l_linenumber AS n, CAST(l_shipdate AS timestamp) AS acquired, CASE l_suppkey % 3 WHEN 0 THEN 'l2a' WHEN 1 THEN 'boa' ELSE 'orbit' END AS source,
  l_partkey % 20 AS cx, (l_partkey // 20) % 10 AS cy, l_orderkey % 4 AS tile_id,
  300 + (l_partkey * 13 + l_suppkey * 7 + l_linenumber * 101) % 4000 AS b03, 300 + (l_partkey * 17 + l_suppkey * 7 + l_linenumber * 101) % 4000 AS b04,
  300 + (l_partkey * 19 + l_suppkey * 7 + l_linenumber * 101) % 4000 AS b05, 300 + (l_partkey * 23 + l_suppkey * 7 + l_linenumber * 101) % 4000 AS b08,
  300 + (l_partkey * 29 + l_suppkey * 7 + l_linenumber * 101) % 4000 AS b8a, 300 + (l_partkey * 31 + l_suppkey * 7 + l_linenumber * 101) % 4000 AS b11,
  CASE WHEN (l_orderkey + l_linenumber) % 10 < 7 THEN 4 ELSE (l_orderkey + l_linenumber) % 12 END AS scl,
  CASE WHEN (l_partkey + l_linenumber * 17) % 10 < 8 THEN (l_partkey + l_linenumber * 17) % 30 ELSE (l_partkey + l_linenumber * 17) % 101 END AS cld,
  CASE WHEN (l_orderkey * 7 + l_partkey * 3 + l_linenumber) % 10 < 6 THEN 0 ELSE (l_orderkey * 7 + l_partkey * 3 + l_linenumber) % 1024 END AS qai,
  (l_orderkey * 5 + l_partkey) % 120 AS terrain, CASE WHEN (l_orderkey + l_suppkey) % 10 < 7 THEN 0 ELSE (l_orderkey + l_suppkey) % 4 END AS cloudmask
FROM {lineitem}""",
    "attempts_v": """
SELECT user_id AS item_id, event_id, CAST(ts AS timestamp) AS ts,
  CASE event_type WHEN 'purchase' THEN 'completed' WHEN 'error' THEN 'error' WHEN 'signup' THEN 'throttled' ELSE 'queued' END AS outcome, CAST(JSONK(props) AS double) AS retry_after
FROM {events}""",
    "job_events_v": """
SELECT user_id AS item_id, event_id, CAST(ts AS timestamp) AS ts, CASE WHEN event_id % 29 = 0 THEN NULL ELSE 'a' || CAST(event_id % 3 AS varchar(20)) END AS asset_key,
  CASE WHEN event_id % 11 < 2 THEN 'asset' WHEN event_type IN ('view', 'signup') AND event_id % 7 <> 0 THEN 'claim' WHEN event_type = 'click' THEN 'start' WHEN event_type = 'purchase' THEN 'completed'
   WHEN event_type = 'error' THEN CASE event_id % 4 WHEN 0 THEN 'error' WHEN 1 THEN 'throttled' WHEN 2 THEN 'interrupted' ELSE 'restart' END END AS kind, CASE WHEN event_id % 5 = 0 THEN NULL ELSE CAST(JSONK(props) AS double) END AS retry_after
FROM {events}""",
    "jobs_v": """
SELECT o_orderkey AS item_id, CAST(o_orderdate AS timestamp) AS item_datetime,
  CASE WHEN o_orderstatus = 'F' THEN CASE WHEN o_orderkey % 11 = 0 THEN 'failed' WHEN o_orderkey % 13 = 0 THEN 'retired' ELSE 'completed' END WHEN o_orderstatus = 'O' THEN CASE WHEN o_orderkey % 3 = 0 THEN 'processing' ELSE 'queued' END ELSE 'retry_wait' END AS status,
  CAST(o_orderkey % 6 AS int) AS attempts, CASE WHEN o_orderstatus = 'P' THEN CAST(o_orderdate AS timestamp) ELSE NULL END AS next_attempt_at
FROM {orders}""",
}


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    text = VIEWS[name].replace(" // ", " div ").replace("JSONK(props)", "get_json_object(props, '$.k')")
    tables = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in set(re.findall(r"\{(\w+)\}", text))}
    return spark.sql(text, **tables)


def with_views(sql: str) -> str:
    """DuckDB text with the views that it names in front."""
    used = [n for n in VIEWS if re.search(rf"\b{n}\b", sql)]
    heads = [f"{n} AS ({re.sub(r'\{(\w+)\}', r'\1', VIEWS[n]).replace('JSONK(props)', "json_extract_string(props, '$.k')")})" for n in used]
    body = sql.strip()
    if body.upper().startswith("WITH RECURSIVE "):
        return f"WITH RECURSIVE {', '.join([*heads, body[15:]])}" if heads else body
    if body.upper().startswith("WITH "):
        return f"WITH {', '.join([*heads, body[5:]])}" if heads else body
    return f"WITH {', '.join(heads)} {body}" if heads else body
