"""Catalogue queries over items and assets."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orbitgrain.functions import predicates as p


def search_items(items: DataFrame, start=None, end=None, bbox=None, max_cloud: float | None = None, collections=(), max_items: int | None = None) -> DataFrame:
    """Both ends of the time included; the row limit, earliest first, comes before the cloud test, as in a catalogue that pages."""
    out = items.filter(p.in_time_range("acquired", start, end))
    if collections:
        out = out.filter(F.col("collection_id").isin(list(collections)))
    if bbox:
        out = out.filter(p.bbox_intersects(*bbox))
    if max_items is not None:
        out = out.orderBy("acquired", "item_id").limit(max_items)
    return out.filter(p.cloud_at_most(max_cloud))


def list_collections(items: DataFrame) -> DataFrame:
    """S03"""
    return items.select("collection_id").distinct()


def explode_assets(items: DataFrame) -> DataFrame:
    """One row for each asset of items (item_id, assets map of structs)."""
    return items.select("item_id", F.explode(F.map_entries("assets")).alias("e")).select("item_id", F.col("e.key").alias("asset_key"), "e.value.*")


def raster_pieces(items: DataFrame, assets: DataFrame, keys=(), bbox=None, start=None, end=None, max_cloud: float | None = None, include_incomplete: bool = False) -> DataFrame:
    """Raster assets with their items, filtered before the join; order it with :func:`in_piece_order`."""
    some = items.filter(p.in_time_range("acquired", start, end) & p.cloud_at_most(max_cloud))
    if bbox:
        some = some.filter(p.bbox_intersects(*bbox))
    pieces = assets.filter(F.col("is_raster") & p.asset_key_in(keys) & p.completed_only(include_incomplete))
    return some.join(pieces, "item_id")


def in_piece_order(pieces: DataFrame) -> DataFrame:
    """O01"""
    return pieces.orderBy("acquired", "tile_id", "asset_key", "item_id")


def dataset_summary(items: DataFrame, assets: DataFrame) -> DataFrame:
    """One row; both sides are aggregated before they meet."""
    done = F.col("status") == "completed"
    counts = assets.agg(F.count(F.lit(1)).alias("assets"), F.count_if(done).alias("completed_assets"), F.coalesce(F.sum(F.when(done, F.col("bytes"))), F.lit(0)).alias("completed_bytes"))
    return items.agg(F.count(F.lit(1)).alias("items")).withColumn("k", F.lit(1)).join(counts.withColumn("k", F.lit(1)), "k").drop("k")


def pieces_per_key(pieces: DataFrame) -> DataFrame:
    """A20"""
    return pieces.groupBy("asset_key").agg(F.count(F.lit(1)).alias("pieces"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"), F.count_if(F.col("local_path").isNull()).alias("missing_files"))


def mean_metadata(items: DataFrame, *columns: str) -> DataFrame:
    """Means without nulls, null if there is none."""
    return items.agg(*(F.avg(c).alias(f"mean_{c}") for c in columns), F.count(F.lit(1)).alias("scenes"))


def newest_item(items: DataFrame) -> DataFrame:
    """W06"""
    return items.orderBy(F.desc("acquired"), F.desc("item_id")).limit(1)


def newest_in_order(items: DataFrame, n: int) -> DataFrame:
    """The newest n, oldest first."""
    return items.orderBy(F.desc("acquired"), F.desc("item_id")).limit(n).orderBy("acquired", "item_id")


def last_events(events: DataFrame, n: int = 20) -> DataFrame:
    """The last n events of each item, oldest first."""
    newest = Window.partitionBy("item_id").orderBy(F.desc("event_id"))
    return events.withColumn("rn", F.row_number().over(newest)).filter(F.col("rn") <= n).drop("rn").orderBy("item_id", "event_id")


def first_of_each(df: DataFrame, key: str, order: str) -> DataFrame:
    """The first row of each key, in the order of first occurrence."""
    return df.groupBy(key).agg(F.min(order).alias(order)).orderBy(order)
