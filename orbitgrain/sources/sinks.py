"""Sinks (S05, S10-S13)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orbitgrain.functions.masks import BANDS, INDICES
from orbitgrain.functions.predicates import month_bounds
from orbitgrain.functions.scalars import iso_z


def write_items(items: DataFrame, path: str, flat: bool = False, mode: str = "append") -> None:
    """By collection, year, month, day and tile, or flat; the item stays a column."""
    if flat:
        items.write.mode(mode).parquet(path)
        return
    dated = items.withColumns({"year": F.year("acquired"), "month": F.month("acquired"), "day": F.dayofmonth("acquired"), "collection": F.col("collection_id"), "tile": F.col("tile_id")})
    keys = ["collection", "year", "month", "day", "tile"]
    dated.repartition(*keys).write.mode(mode).partitionBy(*keys).parquet(path)


def product_stem(source: str, year: int, month: int, resolution: int, tag: str = "") -> str:
    """S10"""
    return f"{source}{tag}_{year:04d}_{month:02d}_{resolution}m"


def write_month(cells: DataFrame, path: str, source: str, year: int, month: int, resolution: int, overwrite: bool = False) -> str:
    """Bands and indices below year=/month=; an existing product is refused unless asked."""
    month_bounds(year, month)
    at = f"{path.rstrip('/')}/source={source}/year={year:04d}/month={month:02d}"
    names = ["cx", "cy", *(c for c in (*BANDS, *INDICES) if c in cells.columns)]
    out = f"{at}/{product_stem(source, year, month, resolution)}"
    cells.select(*names).write.mode("overwrite" if overwrite else "errorifexists").parquet(out)
    return out


def _manifest_columns(quality_rule: str, timings: dict[str, float] | None) -> list[Column]:
    used = F.col("selected")
    return [
        F.lit(quality_rule).alias("quality_rule"), F.array_sort(F.collect_list(F.when(used, F.col("item_id")))).alias("inputs"),
        F.array_sort(F.collect_list(F.when(~used, F.struct("item_id", "reasons")))).alias("skipped"), F.count_if(used).alias("scene_count"), F.avg(F.when(used, F.col("cloud_cover"))).alias("mean_cloud"),
        F.lit(str(dict(sorted(INDICES.items())))).alias("index_definitions"),
        F.create_map(*(F.lit(x) for kv in sorted((timings or {}).items()) for x in kv)).cast("map<string,double>").alias("timings"),
    ]


def manifest(inputs: DataFrame, product: str, quality_rule: str, timings: dict[str, float] | None = None) -> DataFrame:
    """The row of one product from (item_id, cloud_cover, selected, reasons)."""
    return inputs.agg(F.lit(product).alias("product"), *_manifest_columns(quality_rule, timings))


def manifests(inputs: DataFrame, quality_rule: str, timings: dict[str, float] | None = None) -> DataFrame:
    """One row a product from (product, item_id, cloud_cover, selected, reasons); a product's inputs are a month's scenes."""
    return inputs.groupBy("product").agg(*_manifest_columns(quality_rule, timings))


def write_manifest(manifests: DataFrame, path: str) -> None:
    manifests.write.mode("overwrite").json(path)


def composite_item(products: DataFrame) -> DataFrame:
    """Products (product, year, month, west, south, east, north, gsd, scene_count) as one STAC feature of JSON text each."""
    start = F.make_timestamp(F.col("year"), F.col("month"), F.lit(1), F.lit(0), F.lit(0), F.lit(0))
    after = F.add_months(start, 1).cast("timestamp")
    end = F.timestamp_micros(F.unix_micros(after) - 1)
    corner = lambda x, y: F.array(F.col(x), F.col(y))
    ring = F.array(corner("west", "south"), corner("east", "south"), corner("east", "north"), corner("west", "north"), corner("west", "south"))
    properties = F.struct(F.lit(None).cast("string").alias("datetime"), iso_z(start).alias("start_datetime"), F.date_format(end, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("end_datetime"), F.col("gsd"), F.array(*(F.lit(b.upper()) for b in BANDS)).alias("bands"), F.col("scene_count"), (F.current_timestamp() < after).alias("provisional"))
    feature = F.struct(F.lit("Feature").alias("type"), F.col("product").alias("id"), F.array("west", "south", "east", "north").alias("bbox"), F.struct(F.lit("Polygon").alias("type"), F.array(ring).alias("coordinates")).alias("geometry"), properties.alias("properties"))
    return products.select(F.to_json(feature, {"ignoreNullFields": "false"}).alias("value"))


def write_statistics(statistics: DataFrame, path: str) -> None:
    """A row for each source, month and index as CSV, and nested by index as JSON."""
    statistics.write.mode("overwrite").option("header", True).csv(f"{path}/csv")
    keys = ["source", "month"]
    rest = [c for c in statistics.columns if c not in keys]
    statistics.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("index", *(c for c in rest if c != "index")))).alias("indices")).write.mode("overwrite").json(f"{path}/json")
