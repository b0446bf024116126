"""Choice of scenes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FOOTPRINT_SHARE = 0.9  # fixed value


def largest_footprint(items: DataFrame) -> DataFrame:
    """Adds ``tile_area``, the greatest area of the item's tile; a tile of many items is combined before it is dealt."""
    largest = items.groupBy("tile_id").agg(F.max("area").alias("tile_area"))
    return items.join(largest.withColumnRenamed("tile_id", "_tile"), F.col("tile_id").eqNullSafe(F.col("_tile")), "left").drop("_tile")


def near_full(items: DataFrame, share: float = FOOTPRINT_SHARE) -> DataFrame:
    return largest_footprint(items).filter((F.col("tile_area") <= 0) | (F.col("area") >= F.col("tile_area") * share)).drop("tile_area")


def latest_per_tile(items: DataFrame, order=("acquired", "item_id"), share: float = FOOTPRINT_SHARE) -> DataFrame:
    """Of each tile's items with a near-full footprint the last by ``order``.

    Both aggregations combine before the shuffle, so a tile with very many
    items is no hot spot.
    """
    areas = items.groupBy("tile_id").agg(F.max("area").alias("tile_area"))
    full = items.join(areas, "tile_id").filter((F.col("tile_area") <= 0) | (F.col("area") >= F.col("tile_area") * share)).drop("tile_area")
    rest = [c for c in items.columns if c not in order and c != "tile_id"]
    best = full.groupBy("tile_id").agg(F.max(F.struct(*order, *rest)).alias("r"))
    return best.select("tile_id", "r.*").select(*items.columns)


def complete_items(items: DataFrame, assets: DataFrame, required) -> DataFrame:
    """Items that have every required asset."""
    wanted = list(dict.fromkeys(required))
    have = assets.filter(F.col("asset_key").isin(wanted)).groupBy("item_id").agg(F.count_distinct("asset_key").alias("n")).filter(F.col("n") == len(wanted))
    return items.join(have.select("item_id"), "item_id", "left_semi")


def tiles_without(items: DataFrame, chosen: DataFrame) -> DataFrame:
    """Tiles for which nothing was chosen."""
    return items.select("tile_id").distinct().join(chosen.select("tile_id").distinct(), "tile_id", "left_anti")


def bootstrap(items: DataFrame, order=("acquired", "published", "item_id")) -> tuple[DataFrame, DataFrame]:
    """(selected, ignored)."""
    selected = latest_per_tile(items, order)
    return selected, items.join(selected.select("item_id"), "item_id", "left_anti")


def newest_versions(scenes: DataFrame) -> DataFrame:
    """Of each acquisition (platform, sensing, orbit, tile) the greatest baseline, production, id."""
    keys = ["platform", "sensing", "orbit", "tile_id"]
    rest = [c for c in scenes.columns if c not in keys and c not in ("baseline", "production", "item_id")]
    best = scenes.groupBy(*keys).agg(F.max(F.struct(F.col("baseline").cast("int").alias("_b"), "production", "item_id", "baseline", *rest)).alias("r"))
    return best.select(*keys, "r.production", "r.item_id", "r.baseline", *(f"r.{c}" for c in rest)).select(*scenes.columns)


def boa_qai_pairs(scenes: DataFrame, images: DataFrame) -> DataFrame:
    """Each scene with its BOA and QAI mosaic, or the reasons against it."""
    kind = F.col("image_type")
    found = images.groupBy("item_id").agg(
        F.count_if(kind == "BOA_MOSAIC").alias("boa"), F.count_if(kind == "QAI_MOSAIC").alias("qai"),
        F.min(F.when(kind == "BOA_MOSAIC", F.col("local_path"))).alias("boa_path"), F.min(F.when(kind == "QAI_MOSAIC", F.col("local_path"))).alias("qai_path"),
    )
    both = scenes.join(found, "item_id", "left").fillna(0, ["boa", "qai"])
    text = lambda name, c: F.concat(F.lit(f"{name}:"), c.cast("string"))
    reasons = F.array(
        F.when(~F.col("force_status").eqNullSafe("complete"), text("force-status", F.coalesce("force_status", F.lit("none")))),
        F.when(F.col("boa") != 1, text("boa-mosaic-count", F.col("boa"))),
        F.when(F.col("qai") != 1, text("qai-mosaic-count", F.col("qai"))),
        F.when((F.col("boa") == 1) & F.col("boa_path").isNull(), F.lit("boa-mosaic-missing")),
        F.when((F.col("qai") == 1) & F.col("qai_path").isNull(), F.lit("qai-mosaic-missing")),
    )
    return both.withColumn("reasons", F.filter(reasons, lambda r: r.isNotNull())).withColumn("selected", F.size("reasons") == 0).drop("boa", "qai")


def complete_scenes(items: DataFrame, assets: DataFrame, required, max_cloud: float | None = None, available: Column | None = None) -> DataFrame:
    """Items (item_id, tile_id, acquired, cloud_cover) with ``reasons`` and ``selected``.

    X01: ``available`` is the condition on an asset row that its file can be
    read. The assets are folded to one row an item before the join.
    """
    wanted = list(dict.fromkeys(required))
    here = F.lit(True) if available is None else F.coalesce(available, F.lit(False))
    folded = assets.filter(F.col("asset_key").isin(wanted)).groupBy("item_id").agg(F.collect_set("asset_key").alias("present"), F.collect_set(F.when(here, F.col("asset_key"))).alias("readable"))
    both = items.join(folded, "item_id", "left")
    asked = F.array(*map(F.lit, wanted))
    present, readable = F.coalesce("present", F.array().cast("array<string>")), F.coalesce("readable", F.array().cast("array<string>"))
    missing = F.transform(F.array_except(asked, present), lambda k: F.concat(F.lit("missing:"), k))
    unread = F.transform(F.array_except(F.array_intersect(asked, present), readable), lambda k: F.concat(F.lit("missing-file:"), k))
    cloud = F.lit(False) if max_cloud is None else F.coalesce(F.col("cloud_cover") > max_cloud, F.lit(False))
    cloudy = F.when(cloud, F.array(F.concat(F.lit("cloud-cover:"), F.format_string("%.0f", F.col("cloud_cover"))))).otherwise(F.array().cast("array<string>"))
    out = both.withColumn("reasons", F.concat(missing, unread, cloudy)).drop("present", "readable")
    return out.withColumn("selected", F.size("reasons") == 0)


def available_pieces(pieces: DataFrame, inventory: DataFrame, check_size: bool = True) -> tuple[DataFrame, DataFrame]:
    """(pieces with a file, pieces without); a known size must match."""
    files = inventory.select(F.col("path").alias("local_path"), "length").distinct()
    sized = F.col("bytes").isNull() | (F.col("length") == F.col("bytes")) if check_size else F.lit(True)
    marked = pieces.join(files, "local_path", "left").withColumn("_ok", F.coalesce(F.col("length").isNotNull() & sized, F.lit(False)))
    return marked.filter("_ok").select(*pieces.columns), marked.filter("not _ok").select(*pieces.columns)


def new_items(discovered: DataFrame, ingested: DataFrame) -> DataFrame:
    """Discovered items whose id is not in the other table."""
    return discovered.join(ingested.select("item_id").distinct(), "item_id", "left_anti")


def discovery_audit(items: DataFrame, assets: DataFrame, requested) -> DataFrame:
    """P20: requested keys that an item lacks, sorted."""
    wanted = list(dict.fromkeys(requested))
    have = assets.groupBy("item_id").agg(F.collect_set("asset_key").alias("present"))
    both = items.select("item_id").join(have, "item_id", "left")
    lacking = F.array_sort(F.array_except(F.array(*map(F.lit, wanted)), F.coalesce("present", F.array().cast("array<string>"))))
    return both.select("item_id", F.array_join(lacking, ",").alias("missing"), F.size(lacking).alias("n_missing"))
