"""Predicates and derived columns of the catalogue."""

from __future__ import annotations

import re
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The asset keys of the named profiles, in their order.
PROFILES = {
    "native": (
        "B01_60m", "B02_10m", "B03_10m", "B04_10m", "B05_20m", "B06_20m", "B07_20m", "B08_10m", "B8A_20m", "B09_60m", "B11_20m", "B12_20m", "AOT_10m",
        "WVP_10m", "SCL_20m", "SNW_20m", "CLD_20m", "safe_manifest", "product_metadata", "granule_metadata", "datastrip_metadata", "inspire_metadata",
    ),
    "ndvi": (
        "B04_10m", "B08_10m", "SCL_20m", "CLD_20m",
    ),
    "vegetation": (
        "B03_10m", "B04_10m", "B05_20m", "B08_10m", "B8A_20m", "B11_20m", "SCL_20m", "CLD_20m",
    ),
    "metadata-only": (),
}

# Error codes of an object store that mean a quota or throttling.
THROTTLE_CODES = (
    "bandwidthlimitexceeded", "limitexceeded", "quotaexceeded", "requestlimitexceeded", "servicequotaexceeded", "servicequotaexceededexception",
    "slowdown", "throttled", "throttling", "throttlingexception", "toomanyrequests", "toomanyrequestsexception",
)


def bbox_intersects(west: float, south: float, east: float, north: float) -> Column:
    """Footprints touching the box count."""
    return (F.col("east") >= west) & (F.col("west") <= east) & (F.col("north") >= south) & (F.col("south") <= north)


def in_time_range(column: str, start=None, end=None, half_open: bool = False) -> Column:
    """From start to end, the end included unless ``half_open``."""
    keep = F.lit(True)
    if start is not None:
        keep = keep & (F.col(column) >= F.lit(start).cast("timestamp"))
    if end is not None:
        limit = F.lit(end).cast("timestamp")
        keep = keep & ((F.col(column) < limit) if half_open else (F.col(column) <= limit))
    return keep


def month_bounds(year: int, month: int) -> tuple[datetime, datetime]:
    if not (2015 <= year <= 2100 and 1 <= month <= 12):
        raise ValueError(f"not a month of 2015 to 2100: {year}-{month}")
    return datetime(year, month, 1), datetime(year + month // 12, month % 12 + 1, 1)


def in_month(column: str, year: int, month: int) -> Column:
    """UTC month, half open; a plain range, so that files and partitions can be skipped."""
    start, end = (d.strftime("%Y-%m-%d %H:%M:%S") for d in month_bounds(year, month))
    return in_time_range(column, start, end, half_open=True)


def cloud_at_most(limit: float | None, column: str = "cloud_cover") -> Column:
    """Unknown cover passes, as does any cover without a limit."""
    return F.lit(True) if limit is None else F.col(column).isNull() | (F.col(column) <= limit)


def completed_only(include_incomplete: bool = False) -> Column:
    """P05"""
    return F.lit(True) if include_incomplete else F.col("status") == "completed"


def asset_key_in(keys=()) -> Column:
    """No keys means all."""
    keys = list(dict.fromkeys(keys))
    return F.col("asset_key").isin(keys) if keys else F.lit(True)


def is_raster(media_type: Column, href: Column) -> Column:
    """By media type, else by the suffix of the path without its query."""
    media = F.lower(F.coalesce(media_type, F.lit("")))
    path = F.lower(F.regexp_replace(F.coalesce(href, F.lit("")), r"[?#].*$", ""))
    return media.startswith("image/") | media.contains("geotiff") | media.contains("jp2") | path.rlike(r"\.(jp2|tiff?|vrt)$")


def asset_resolution(asset_key: Column, gsd: Column) -> Column:
    """Metres from the key's ending, else the ground sample distance."""
    return F.coalesce(F.nullif(F.regexp_extract(asset_key, r"_(\d+)m$", 1), F.lit("")).try_cast("double"), gsd.try_cast("double"))


def asset_epsg(epsg: Column, code: Column) -> Column:
    """P09"""
    return F.coalesce(epsg.try_cast("int"), F.nullif(F.regexp_extract(F.upper(code), r"^EPSG:(\d+)$", 1), F.lit("")).try_cast("int"))


def tile_id(item_id: Column, mgrs_tile: Column, other_tile: Column | None = None, zone: Column | None = None, band: Column | None = None, square: Column | None = None) -> Column:
    """P10: first of the known properties, then the tile in the id, then the id."""
    some = [F.nullif(c, F.lit("")) for c in (mgrs_tile, other_tile) if c is not None]
    if zone is not None and band is not None and square is not None:
        some.append(F.concat(zone.cast("string"), band, square))
    return F.coalesce(*some, F.nullif(F.regexp_extract(item_id, r"_T(\d{2}[A-Z]{3})", 1), F.lit("")), item_id)


def item_datetime(*texts: Column) -> Column:
    """First text that is a time; without an offset it is UTC."""
    return F.coalesce(*(F.try_to_timestamp(t) for t in texts))


PRODUCT_NAME = r"^(S2[ABC])_MSIL(1C|2A)_(\d{8}T\d{6})_N(\d{4})_R(\d{3})_T(\d{2}[A-Z]{3})_(\d{8}T\d{6})(?:\.SAFE)?$"
PRODUCT_PARTS = ("platform", "level", "sensing", "baseline", "orbit", "tile", "production")


def parse_product(name: Column) -> dict[str, Column]:
    """The parts of a product name, null where the name does not match."""
    fits = name.rlike(PRODUCT_NAME)
    return {part: F.when(fits, F.regexp_extract(name, PRODUCT_NAME, i + 1)) for i, part in enumerate(PRODUCT_PARTS)}


def first_product_name(*names: Column) -> Column:
    """The first of several fields that is a product name."""
    return F.coalesce(*(F.when(n.rlike(PRODUCT_NAME), n) for n in names))


def sensor_in(sensors, column: str = "platform") -> Column:
    """P13"""
    return F.col(column).isin(list(sensors))


def pixel_window(envelope: tuple[float, float, float, float], size: tuple[int, int], transform: tuple[float, ...], buffer: int = 0) -> tuple[int, int, int, int] | None:
    """(column, row, width, height) of whole pixels covering an envelope (x0, y0, x1, y1); None if disjoint.

    Grids that are not north-up are refused.
    """
    import math

    x0, dx, skew_x, y0, skew_y, dy = transform
    if skew_x or skew_y or dx <= 0 or dy >= 0:
        raise ValueError("the grid is not north-up")
    west, south, east, north = envelope
    left, right = math.floor((west - x0) / dx) - buffer, math.ceil((east - x0) / dx) + buffer
    top, bottom = math.floor((north - y0) / dy) - buffer, math.ceil((south - y0) / dy) + buffer
    left, top, right, bottom = max(0, left), max(0, top), min(size[0], right), min(size[1], bottom)
    return (left, top, right - left, bottom - top) if left < right and top < bottom else None


def in_pixel_window(window: tuple[int, int, int, int]) -> Column:
    """P14 on cells (cx, cy)."""
    left, top, width, height = window
    return F.col("cx").between(left, left + width - 1) & F.col("cy").between(top, top + height - 1)


def blocks_in_window(window: tuple[int, int, int, int], block: int = 512) -> Column:
    """P14 on blocks (bx, by), to be applied before a block is opened."""
    left, top, width, height = window
    return F.col("bx").between(left // block, (left + width - 1) // block) & F.col("by").between(top // block, (top + height - 1) // block)


def profile_table(spark: SparkSession, profile: str, custom=()) -> DataFrame:
    """(profile, ord, asset_key), a fixed small table."""
    keys = list(dict.fromkeys(custom)) if profile == "custom" else PROFILES[profile]
    return spark.createDataFrame([(profile, i, k) for i, k in enumerate(keys)], "profile string, ord int, asset_key string")


def select_one(assets: DataFrame, title: str | None = None, suffix: str | None = None) -> DataFrame:
    """For each item the asset with a title, or with ``_<suffix>.tif`` at the key's end; a reason where it is not exactly one."""
    match = F.lower("title") == title.lower() if title is not None else F.col("asset_key").endswith(f"_{suffix}.tif")
    name = title if title is not None else suffix
    found = assets.groupBy("item_id").agg(F.count_if(match).alias("matches"), F.min(F.when(match, F.col("asset_key"))).alias("asset_key"))
    return found.select("item_id", F.when(F.col("matches") == 1, F.col("asset_key")).alias("asset_key"), F.when(F.col("matches") != 1, F.concat(F.lit(f"asset-count:{name}:"), F.col("matches").cast("string"))).alias("reason"))


def band_positions(stacks: DataFrame, wanted=("B03", "B04", "B05", "B08", "B8A", "B11")) -> DataFrame:
    """(item_id, band, stack, position from 1) of stacks (item_id, stack, bands array); null where a band is missing."""
    names = F.transform("bands", lambda b: F.regexp_replace(F.upper(b), r"^B(\d)$", "B0$1"))
    here = stacks.select("item_id", "stack", F.posexplode(names).alias("pos", "band")).filter(F.col("band").isin(list(wanted)))
    asked = stacks.select("item_id").distinct().select("item_id", F.explode(F.array(*map(F.lit, wanted))).alias("band"))
    first = here.groupBy("item_id", "band").agg(F.min(F.struct("stack", (F.col("pos") + 1).alias("position"))).alias("at"))
    return asked.join(first, ["item_id", "band"], "left").select("item_id", "band", "at.stack", "at.position")


def has_all(titles: str, required) -> Column:
    """Every required title, case aside."""
    lower = F.transform(F.col(titles), lambda t: F.lower(t))
    return F.forall(F.array(*(F.lit(r.lower()) for r in required)), lambda r: F.array_contains(lower, r))


def missing_keys(requested: str, present: str) -> Column:
    """P20"""
    return F.array_sort(F.array_except(F.coalesce(F.col(requested), F.array()), F.coalesce(F.col(present), F.array())))


def is_throttled(status: Column, code: Column) -> Column:
    """P21"""
    return F.coalesce(status.isin(429, 509), F.lit(False)) | F.coalesce(F.lower(code).isin(list(THROTTLE_CODES)), F.lit(False))


def retry_after_seconds(value: Column, now: Column) -> Column:
    """Seconds, or an HTTP date relative to ``now``; never negative."""
    date = F.unix_timestamp(F.try_to_timestamp(F.regexp_replace(value, r"^\w{3}, | GMT$", ""), F.lit("dd MMM yyyy HH:mm:ss"))) - F.unix_timestamp(now)
    return F.greatest(F.lit(0.0), F.coalesce(value.try_cast("double"), date.cast("double")))


def safe_stem(name: str) -> str:
    return re.sub(r"[^A-Za-z0-9_.-]+", "_", name)
