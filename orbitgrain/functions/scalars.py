"""Scalar functions as Columns (F01-F15). Rings are arrays of arrays [x, y]."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def ring_area(ring: Column) -> Column:
    """shoelace area of a closed or open ring; 0 for null."""
    ahead = F.concat(F.slice(ring, 2, F.greatest(F.size(ring) - 1, F.lit(0))), F.slice(ring, 1, 1))
    terms = F.zip_with(ring, ahead, lambda p, q: F.get(p, 0) * F.get(q, 1) - F.get(q, 0) * F.get(p, 1))
    return F.when(F.size(ring) > 2, F.abs(F.aggregate(terms, F.lit(0.0), lambda a, t: a + t)) / 2).otherwise(0.0)


def polygon_area(rings: Column) -> Column:
    """first ring less its holes, never negative."""
    areas = F.transform(rings, ring_area)
    outer = F.coalesce(F.get(areas, 0), F.lit(0.0))
    holes = F.aggregate(F.slice(areas, 2, F.greatest(F.size(areas) - 1, F.lit(0))), F.lit(0.0), lambda a, x: a + x)
    return F.greatest(F.lit(0.0), outer - holes)


def geometry_area(polygons: Column) -> Column:
    """of a MultiPolygon given as an array of polygons; 0 for null."""
    return F.coalesce(F.aggregate(F.transform(polygons, polygon_area), F.lit(0.0), lambda a, x: a + x), F.lit(0.0))


def positions(polygons: Column) -> Column:
    """F02"""
    return F.flatten(F.flatten(polygons))


def geometry_bbox(polygons: Column) -> Column:
    """struct west, south, east, north."""
    x, y = F.transform(positions(polygons), lambda p: F.get(p, 0)), F.transform(positions(polygons), lambda p: F.get(p, 1))
    return F.struct(F.array_min(x).alias("west"), F.array_min(y).alias("south"), F.array_max(x).alias("east"), F.array_max(y).alias("north"))


def valid_geometry(polygons: Column) -> Column:
    """positions on the globe and an area."""
    on_globe = F.forall(positions(polygons), lambda p: F.get(p, 0).between(-180, 180) & F.get(p, 1).between(-90, 90))
    return F.coalesce(on_globe & (geometry_area(polygons) > 0), F.lit(False))


METRES_PER_DEGREE = 111_320.0  # fixed value


def bbox_around(lon: Column, lat: Column, width_m: Column, height_m: Column) -> Column:
    """F03"""
    dx, dy = width_m / (METRES_PER_DEGREE * F.cos(F.radians(lat))) / 2, height_m / METRES_PER_DEGREE / 2
    return F.struct((lon - dx).alias("west"), (lat - dy).alias("south"), (lon + dx).alias("east"), (lat + dy).alias("north"))


def bbox_size(west: Column, south: Column, east: Column, north: Column, resolution: Column) -> Column:
    """pixels across and down, at least 1."""
    middle = F.radians((south + north) / 2)
    width = F.greatest(F.lit(1), F.round((east - west) * METRES_PER_DEGREE * F.cos(middle) / resolution).cast("int"))
    height = F.greatest(F.lit(1), F.round((north - south) * METRES_PER_DEGREE / resolution).cast("int"))
    return F.struct(width.alias("width"), height.alias("height"))


def edge_points(west: Column, south: Column, east: Column, north: Column, samples: int = 21) -> Column:
    """points along the four edges of a box."""
    steps = F.sequence(F.lit(0), F.lit(samples - 1))
    share = lambda i: i / F.lit(float(samples - 1))
    bottom = F.transform(steps, lambda i: F.struct((west + (east - west) * share(i)).alias("x"), south.alias("y")))
    top = F.transform(steps, lambda i: F.struct((west + (east - west) * share(i)).alias("x"), north.alias("y")))
    left = F.transform(steps, lambda i: F.struct(west.alias("x"), (south + (north - south) * share(i)).alias("y")))
    right = F.transform(steps, lambda i: F.struct(east.alias("x"), (south + (north - south) * share(i)).alias("y")))
    return F.concat(bottom, top, left, right)


def envelope(points: Column) -> Column:
    """F04"""
    x, y = F.transform(points, lambda p: p["x"]), F.transform(points, lambda p: p["y"])
    return F.struct(F.array_min(x).alias("west"), F.array_min(y).alias("south"), F.array_max(x).alias("east"), F.array_max(y).alias("north"))


def raster_extent(x0: Column, dx: Column, skew_x: Column, y0: Column, skew_y: Column, dy: Column, width: Column, height: Column) -> Column:
    """null for a grid that is not north-up."""
    box = F.struct(x0.alias("west"), (y0 + dy * height).alias("south"), (x0 + dx * width).alias("east"), y0.alias("north"))
    return F.when((skew_x == 0) & (skew_y == 0) & (dx > 0) & (dy < 0), box)


MERCATOR_LIMIT = 85.05112878  # fixed value


def mercator_y(lat: Column) -> Column:
    """F06"""
    clamped = F.greatest(F.least(lat, F.lit(MERCATOR_LIMIT)), F.lit(-MERCATOR_LIMIT))
    return F.log(F.tan(F.lit(math.pi / 4) + F.radians(clamped) / 2))


def parse_time(text: Column, is_end: bool = False) -> Column:
    """a date alone is its midnight, or as an end the next one; without an offset UTC."""
    day = text.rlike(r"^\d{4}-\d{2}-\d{2}$")
    at = F.try_to_timestamp(text)
    return F.when(day & F.lit(is_end), at + F.expr("INTERVAL 1 DAY")).otherwise(at)


def iso_z(ts: Column) -> Column:
    """sorts as the time does."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def interval_text(start: Column, end: Column) -> Column:
    """an open side is two dots."""
    return F.concat(F.coalesce(iso_z(start), F.lit("..")), F.lit("/"), F.coalesce(iso_z(end), F.lit("..")))


def normal_checksum(text: Column) -> Column:
    """64 hex digits from a prefixed digest, a multihash or plain hex; null otherwise."""
    bare = F.regexp_replace(F.lower(F.trim(text)), r"^(sha256:|1220(?=[0-9a-f]{64}$))", "")
    return F.when(bare.rlike(r"^[0-9a-f]{64}$"), bare)


def safe_component(text: Column) -> Column:
    """F10"""
    bare = F.regexp_replace(F.regexp_replace(F.coalesce(text, F.lit("")), r"[^A-Za-z0-9._-]+", "_"), r"^[._]+|[._]+$", "")
    return F.coalesce(F.nullif(bare, F.lit("")), F.lit("unknown"))


def safe_suffix(href: Column) -> Column:
    """at most 12 characters, else ``.bin``."""
    path = F.regexp_replace(F.coalesce(href, F.lit("")), r"[?#].*$", "")
    suffix = F.regexp_extract(path, r"[^/](\.[A-Za-z0-9]+)$", 1)
    return F.when((F.length(suffix) > 0) & (F.length(suffix) <= 12), suffix).otherwise(".bin")


def retry_delay(attempts: Column, base: float = 60.0, longest: float = 3600.0) -> Column:
    """F11"""
    return F.least(F.lit(longest), F.lit(base) * F.pow(F.lit(2.0), F.least(attempts, F.lit(60))))


def quota_delay(retry_after: Column, default: float = 900.0) -> Column:
    """F11"""
    return F.coalesce(retry_after, F.lit(default))


def json_or_text(text: Column) -> Column:
    """the value of a JSON string, numbers and the rest as they are written."""
    return F.coalesce(F.get_json_object(F.concat(F.lit('{"v":'), text, F.lit("}")), "$.v"), text)


def s3_parts(uri: Column) -> Column:
    """struct bucket, key; null where it is no such address."""
    fits = uri.rlike(r"^s3://[^/]+/.+$")
    return F.when(fits, F.struct(F.regexp_extract(uri, r"^s3://([^/]+)/(.+)$", 1).alias("bucket"), F.regexp_extract(uri, r"^s3://([^/]+)/(.+)$", 2).alias("key")))


def fingerprint(*columns: str) -> Column:
    """of the named columns in the order of their names."""
    return F.sha2(F.to_json(F.struct(*sorted(columns))).cast("binary"), 256)
