"""Audits over file listings and job tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The thirteen bands of a product and its root files.
SAFE_BANDS = ("B01", "B02", "B03", "B04", "B05", "B06", "B07", "B08", "B8A", "B09", "B10", "B11", "B12")
ROOT_FILES = ("manifest.safe", "MTD_MSIL1C.xml")


def run_results(results: DataFrame) -> DataFrame:
    """(item_id, asset_key, outcome ok/skipped/failed): counts, and complete if there is an asset and none failed."""
    o = F.col("outcome")
    return results.groupBy("item_id").agg(F.count_if(o == "ok").alias("ok"), F.count_if(o == "skipped").alias("skipped"), F.count_if(o == "failed").alias("failed"), F.bool_and(o != "failed").alias("complete"))


def safe_audit(listing: DataFrame, bands=SAFE_BANDS, roots=ROOT_FILES) -> DataFrame:
    """(product, path) to one row a product: granules, problems, complete.

    A product needs its root files and a granule, a granule its metadata file
    and exactly the thirteen bands. Paths are folded in two steps, granule then
    product.
    """
    granule = F.nullif(F.regexp_extract("path", r"GRANULE/([^/]+)/", 1), F.lit(""))
    band = F.nullif(F.regexp_extract("path", r"IMG_DATA/[^/]*_(B\d[0-9A])\.jp2$", 1), F.lit(""))
    rows = listing.select("product", F.coalesce(granule, F.lit("")).alias("granule"), band.alias("band"), F.col("path").endswith("/MTD_TL.xml").alias("meta"), F.when(F.col("path").isin(list(roots)), F.col("path")).alias("root"))
    folded = rows.groupBy("product", "granule").agg(F.collect_set("band").alias("bands"), F.count("band").alias("files"), F.max("meta").alias("meta"), F.collect_set("root").alias("roots"))
    wanted = F.array_sort(F.array(*map(F.lit, bands)))
    good = F.col("meta") & (F.array_sort("bands") == wanted) & (F.col("files") == len(bands))
    inner = F.col("granule") != ""
    out = folded.groupBy("product").agg(F.count_if(inner).alias("granules"), F.count_if(inner & ~good).alias("bad_granules"), F.max(F.size("roots")).alias("root_files"))
    return out.withColumn("complete", (F.col("granules") > 0) & (F.col("bad_granules") == 0) & (F.col("root_files") == len(roots)))


def set_fingerprint(objects: DataFrame, key: str = "product") -> DataFrame:
    """SHA-256 over the sorted (path, size, etag) of each product."""
    return objects.groupBy(key).agg(F.sha2(F.to_json(F.array_sort(F.collect_list(F.struct("path", "size", "etag")))).cast("binary"), 256).alias("fingerprint"))


def level2_status(jobs: DataFrame, files: DataFrame, now=None) -> DataFrame:
    """Jobs (job, status, queue_status, progress_phase, started_at) with their output counts, bytes and phase."""
    kind = F.col("kind")
    out = files.groupBy("job").agg(F.count_if(kind == "BOA").alias("boa"), F.count_if(kind == "QAI").alias("qai"), F.count_if(kind == "OVV").alias("overviews"), F.sum("length").alias("bytes"), F.max("modified").alias("latest"))
    both = jobs.join(out, "job", "left").fillna(0, ["boa", "qai", "overviews", "bytes"])
    phase = (
        F.when((F.col("status") == "processing") & F.col("progress_phase").isNotNull(), F.col("progress_phase")).when(F.col("status") == "complete", "complete").when(F.col("status").isin("failed", "interrupted"), F.col("status"))
        .when(F.col("queue_status") == "DONE", "validation-or-mosaic").when((F.col("boa") > 0) | (F.col("qai") > 0), "writing-force-tiles").otherwise("force-l2ps-core")
    )
    until = F.current_timestamp() if now is None else F.lit(now).cast("timestamp")
    elapsed = F.greatest(F.lit(0.0), (F.unix_micros(until) - F.unix_micros("started_at")) / 1e6)
    return both.withColumns({"phase": phase, "elapsed_s": F.when(F.col("started_at").isNotNull(), elapsed)})


def output_triples(files: DataFrame) -> DataFrame:
    """(job, kind, length, mosaic): tile counts equal and positive, no empty file, both mosaics there."""
    tile = ~F.col("mosaic")
    of = lambda k: F.count_if(tile & (F.col("kind") == k))
    out = files.groupBy("job").agg(of("BOA").alias("boa"), of("QAI").alias("qai"), of("OVV").alias("ovv"), F.count_if(F.col("length") <= 0).alias("empty"), F.count_distinct(F.when(F.col("mosaic") & F.col("kind").isin("BOA", "QAI"), F.col("kind"))).alias("mosaics"))
    return out.withColumn("ok", (F.col("boa") > 0) & (F.col("boa") == F.col("qai")) & (F.col("boa") == F.col("ovv")) & (F.col("empty") == 0) & (F.col("mosaics") == 2))


def cube_audit(headers: DataFrame, x0: float, y0: float, size: float) -> DataFrame:
    """(job, kind, tile, width, height, origin_x, origin_y, length) to the tiles with a problem."""
    tx, ty = F.regexp_extract("tile", r"^X(\d+)_Y", 1).cast("int"), F.regexp_extract("tile", r"_Y(\d+)$", 1).cast("int")
    off = (F.abs(F.col("origin_x") - (x0 + tx * size)) > 1e-6) | (F.abs(F.col("origin_y") - (y0 - ty * size)) > 1e-6)
    out = headers.groupBy("job", "tile").agg(F.count_distinct("kind").alias("kinds"), F.count_distinct("width", "height").alias("grids"), F.count_if(off).alias("off"), F.count_if(F.col("length") <= 0).alias("empty"))
    reasons = F.array(F.when(F.col("kinds") < 3, F.lit("kinds")), F.when(F.col("grids") > 1, F.lit("grid")), F.when(F.col("off") > 0, F.lit("origin")), F.when(F.col("empty") > 0, F.lit("empty")))
    return out.select("job", "tile", F.filter(reasons, lambda r: r.isNotNull()).alias("problems")).filter(F.size("problems") > 0)


def reconcile(expected: DataFrame, present: DataFrame, keys=("path",)) -> DataFrame:
    """Each path as ok, missing, extra, size or hash."""
    e, q = expected.select(*keys, F.col("size").alias("want_size"), F.col("sha256").alias("want_hash")).withColumn("_e", F.lit(True)), present.select(*keys, F.col("size").alias("got_size"), F.col("sha256").alias("got_hash")).withColumn("_p", F.lit(True))
    both = e.join(q, list(keys), "full_outer")
    kind = F.when(F.col("_p").isNull(), "missing").when(F.col("_e").isNull(), "extra").when(~F.col("want_size").eqNullSafe(F.col("got_size")), "size").when(F.col("want_hash").isNotNull() & ~F.col("want_hash").eqNullSafe(F.col("got_hash")), "hash").otherwise("ok")
    return both.select(*keys, kind.alias("class"))


def unchanged(reconciled: DataFrame, fingerprints: DataFrame, previous: DataFrame, key: str = "product") -> DataFrame:
    """Products whose fingerprint is as before and whose files are all in order can be skipped."""
    good = reconciled.groupBy(key).agg(F.bool_and(F.col("class") == "ok").alias("good")).filter("good").select(key)
    return fingerprints.join(previous.select(key, F.col("fingerprint").alias("_f")), key).filter("fingerprint = _f").select(key).join(good, key, "left_semi")


def find_products(files: DataFrame, requested: DataFrame, token: str | None = None) -> DataFrame:
    """Requested (source, year, month) with the one file of each kind, or a reason.

    files: (source, year, month, kind, path); ``token`` must occur in the name.
    """
    if token:
        files = files.filter(F.regexp_extract("path", r"([^/]+)$", 1).contains(token))
    keys, kinds = ["source", "year", "month"], ("reflectance", "indices", "manifest")
    found = files.groupBy(*keys).agg(*(F.count_if(F.col("kind") == k).alias(f"n_{k}") for k in kinds), *(F.min(F.when(F.col("kind") == k, F.col("path"))).alias(k) for k in kinds))
    both = requested.join(found, keys, "left").fillna(0, [f"n_{k}" for k in kinds])
    reasons = F.filter(F.array(*(F.when(F.col(f"n_{k}") != 1, F.concat(F.lit(f"{k}-count:"), F.col(f"n_{k}").cast("string"))) for k in kinds)), lambda r: r.isNotNull())
    return both.select(*keys, *kinds, reasons.alias("reasons"))


def queue_status(scenes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(queue lines in order, rejects): downloaded scenes with a path; paths with white space are refused."""
    s = F.col("force_status")
    rows = scenes.filter("download_status = 'complete' and local_path is not null").withColumn("queue", F.when(s == "complete", "DONE").when(s.isin("failed", "interrupted"), "FAIL").otherwise("QUEUED"))
    odd = F.col("local_path").rlike(r"\s")
    return rows.filter(~odd).orderBy("acquired", "item_id"), rows.filter(odd)


def run_counts(outcomes: DataFrame) -> DataFrame:
    """(run_id, item_id, stage, outcome) folded by item, then counted by run.

    An item is failed if its last stage failed, partial if it stopped between,
    skipped if all its stages were skipped, else processed.
    """
    last = outcomes.groupBy("run_id", "item_id").agg(F.max_by("outcome", "stage").alias("last"), F.max("stage").alias("stage"), F.bool_and(F.col("outcome") == "skipped").alias("skipped"), F.count_if((F.col("stage") == 0) & (F.col("outcome") == "ok")).alias("down"))
    final = outcomes.agg(F.max("stage").alias("final"))
    both = last.withColumn("k", F.lit(1)).join(F.broadcast(final.withColumn("k", F.lit(1))), "k").drop("k")  # one row
    kind = F.when(F.col("skipped"), "skipped").when(F.col("last") == "failed", "failed").when(F.col("stage") < F.col("final"), "partial").otherwise("processed")
    return both.withColumn("kind", kind).groupBy("run_id").agg(F.sum("down").alias("downloaded"), *(F.count_if(F.col("kind") == k).alias(k) for k in ("processed", "skipped", "partial", "failed")))
