"""Scans of item documents, regions and file inventories."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orbitgrain.functions import scalars

ASSET = "struct<href:string,type:string,title:string,roles:array<string>,`proj:code`:string,`proj:epsg`:int,`proj:shape`:array<int>,`proj:transform`:array<double>,gsd:double,nodata:double,data_type:string,`raster:scale`:double,`raster:offset`:double,`file:size`:bigint,`file:checksum`:string,bands:array<struct<name:string>>>"
STAC = f"id string, collection string, bbox array<double>, geometry struct<type:string,coordinates:string>, properties string, assets map<string,{ASSET}>, datetime string, _bad string"


def read_stac_items(spark: SparkSession, path: str, lines: bool = False, files: str = "*.json") -> tuple[DataFrame, DataFrame]:
    """(items, failures) from one JSON document a file, or a line where ``lines``; properties stay a JSON string."""
    reader = spark.read.schema(STAC).option("multiLine", not lines).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_bad")
    raw = reader.option("recursiveFileLookup", True).option("pathGlobFilter", files).json(path).withColumn("path", F.input_file_name())
    bad = F.col("_bad").isNotNull() | F.col("id").isNull()
    return raw.filter(~bad).drop("_bad"), raw.filter(bad).select("path", F.when(F.col("_bad").isNotNull(), "not-json").otherwise("no-id").alias("reason"))


def read_inventory(spark: SparkSession, path: str, hashes: bool = True) -> DataFrame:
    """(path, length, modified, sha256) of files below a root; without hashes no file is opened."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    digest = F.sha2(F.col("content"), 256) if hashes else F.lit(None).cast("string")
    return files.select("path", "length", F.col("modificationTime").alias("modified"), digest.alias("sha256"))


POLYGONS = "array<array<array<array<double>>>>"


def read_regions(spark: SparkSession, path: str) -> DataFrame:
    """One row a file: polygons of all its features together, bounding box, fingerprint, validity."""
    text = spark.read.option("wholetext", True).text(path).withColumn("roi_id", F.input_file_name())
    return regions_from_json(text)


def regions_from_json(text: DataFrame) -> DataFrame:
    """S08 for rows (roi_id, value): a geometry, a feature or a collection, as GeoJSON text."""
    geometry = "type string, coordinates string"
    feature = f"struct<geometry:struct<{geometry.replace(' string', ':string')}>>"
    doc = F.from_json("value", f"type string, coordinates string, geometry struct<type:string,coordinates:string>, features array<{feature}>")
    parsed = text.select("roi_id", doc.alias("d"))
    every = F.when(F.col("d.features").isNotNull(), F.transform("d.features", lambda f: f["geometry"])).when(F.col("d.geometry").isNotNull(), F.array("d.geometry")).otherwise(F.array(F.struct(F.col("d.type").alias("type"), F.col("d.coordinates").alias("coordinates"))))
    one = parsed.select("roi_id", F.explode(every).alias("g")).select("roi_id", "g.type", "g.coordinates")
    polygon = F.array(F.from_json("coordinates", "array<array<array<double>>>"))
    shaped = one.withColumn("polygons", F.when(F.col("type") == "MultiPolygon", F.from_json("coordinates", POLYGONS)).when(F.col("type") == "Polygon", polygon))
    whole = shaped.groupBy("roi_id").agg(F.flatten(F.collect_list("polygons")).alias("polygons"), F.bool_and(F.col("polygons").isNotNull()).alias("known"))
    box = whole.withColumn("b", scalars.geometry_bbox(F.col("polygons")))
    valid = F.col("known") & scalars.valid_geometry(F.col("polygons"))
    return box.select("roi_id", "polygons", "b.west", "b.south", "b.east", "b.north", F.sha2(F.to_json("polygons").cast("binary"), 256).alias("fingerprint"), valid.alias("valid"))
