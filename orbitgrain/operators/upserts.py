"""Keyed merges of state tables (U01-U10). Each returns the new table; the writer decides where it goes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def latest_rows(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """One row for each key: the greatest by ``order``; ties by the rest of the row."""
    rest = [c for c in df.columns if c not in keys and c != order]
    best = df.groupBy(*keys).agg(F.max(F.struct(order, *rest)).alias("r"))
    return best.select(*keys, "r.*").select(*df.columns)


def upsert(old: DataFrame, new: DataFrame, keys: list[str], update: list[str] | None = None) -> DataFrame:
    """Rows of ``new`` replace or join those of ``old``.

    Only the columns in ``update`` change in rows that exist; the others keep
    their old value. ``new`` has one row for each key.
    """
    update = [c for c in old.columns if c not in keys] if update is None else update
    o, n = old.withColumn("_old", F.lit(True)), new.withColumn("_new", F.lit(True))
    o, n = o.withColumnsRenamed({c: f"_o_{c}" for c in old.columns if c not in keys}), n.withColumnsRenamed({c: f"_n_{c}" for c in new.columns if c not in keys})
    both = o.join(n, keys, "full_outer")

    def merged(c: str) -> Column:
        mine, theirs = F.col(f"_o_{c}"), F.col(f"_n_{c}") if c in new.columns else F.lit(None)
        take = F.col("_old").isNull() if c not in update else F.col("_new")
        return F.when(take, theirs).otherwise(mine).alias(c)

    return both.select(*(c if c in keys else merged(c) for c in old.columns))


def upsert_assets(old: DataFrame, new: DataFrame, keep_results: bool = False) -> DataFrame:
    """(item_id, asset_key, href, local_path, status, attempts, bytes, sha256, last_error).

    A new place (href or local_path) queues the asset anew and clears its
    results; ``keep_results`` resets the status only.
    """
    keys = ["item_id", "asset_key"]
    o, n = old.alias("o"), new.select(*keys, "href", "local_path").withColumn("_new", F.lit(True)).alias("n")
    both = o.join(n, keys, "full_outer")
    known, seen = F.col("o.status").isNotNull(), F.col("n._new").isNotNull()
    moved = seen & ~(F.col("o.href").eqNullSafe(F.col("n.href")) & F.col("o.local_path").eqNullSafe(F.col("n.local_path")))
    fresh = ~known | moved
    clear = ~known | (F.lit(False) if keep_results else moved)
    out = {
        "href": F.when(seen, F.col("n.href")).otherwise(F.col("o.href")),
        "local_path": F.when(seen, F.col("n.local_path")).otherwise(F.col("o.local_path")),
        "status": F.when(fresh, F.lit("queued")).otherwise(F.col("o.status")),
        "attempts": F.when(clear, F.lit(0)).otherwise(F.col("o.attempts")),
        "bytes": F.when(~clear, F.col("o.bytes")),
        "sha256": F.when(~clear, F.col("o.sha256")),
        "last_error": F.when(~clear, F.col("o.last_error")),
    }
    return both.select(*keys, *(c.alias(k) for k, c in out.items()))


def upsert_jobs(old: DataFrame, new: DataFrame) -> DataFrame:
    """(item_id, item_datetime, status, attempts, next_attempt_at, last_error, requested_assets, missing_assets).

    Another set of requested or missing assets queues the job anew.
    ``changed`` tells inserted and queued jobs.
    """
    lists = ("requested_assets", "missing_assets")
    n = new.select("item_id", "item_datetime", *(F.array_sort(F.array_distinct(c)).alias(c) for c in lists)).withColumn("_new", F.lit(True))
    both = old.alias("o").join(n.alias("n"), "item_id", "full_outer")
    known, seen = F.col("o.status").isNotNull(), F.col("n._new").isNotNull()
    differs = seen & ~(F.col("o.requested_assets").eqNullSafe(F.col("n.requested_assets")) & F.col("o.missing_assets").eqNullSafe(F.col("n.missing_assets")))
    fresh = ~known | differs
    return both.select(
        "item_id",
        F.when(seen, F.col("n.item_datetime")).otherwise(F.col("o.item_datetime")).alias("item_datetime"),
        F.when(fresh, F.lit("queued")).otherwise(F.col("o.status")).alias("status"),
        F.when(fresh, F.lit(0)).otherwise(F.col("o.attempts")).alias("attempts"),
        F.when(~fresh, F.col("o.next_attempt_at")).alias("next_attempt_at"),
        F.when(~fresh, F.col("o.last_error")).alias("last_error"),
        *(F.when(seen, F.col(f"n.{c}")).otherwise(F.col(f"o.{c}")).alias(c) for c in lists),
        fresh.alias("changed"),
    )


def retain_selected(assets: DataFrame, selection: DataFrame, items: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(queue without what is no longer selected, catalogue with it marked ``unselected``), for the given items only."""
    keys = ["item_id", "asset_key"]
    marked = assets.join(items.select("item_id").distinct().withColumn("_touched", F.lit(True)), "item_id", "left").join(selection.select(*keys).distinct().withColumn("_chosen", F.lit(True)), keys, "left")
    gone = F.col("_touched").isNotNull() & F.col("_chosen").isNull()
    queue = marked.filter(~gone).select(*assets.columns)
    catalogue = marked.withColumn("status", F.when(gone, F.lit("unselected")).otherwise(F.col("status"))).select(*assets.columns)
    return queue, catalogue


def sync_status(catalogue: DataFrame, queue: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """The queue's values where it knows the row."""
    q = queue.select(*keys, *(F.col(c).alias(f"_q_{c}") for c in columns)).withColumn("_q", F.lit(True))
    both = catalogue.join(q, keys, "left")
    return both.select(*(F.when(F.col("_q"), F.col(f"_q_{c}")).otherwise(F.col(c)).alias(c) if c in columns else F.col(c) for c in catalogue.columns))


def enrich_rasters(assets: DataFrame, headers: DataFrame) -> DataFrame:
    """Header values win; the EPSG code only where the file gives one."""
    names = ("driver", "raster_dtype", "width", "height", "epsg")
    h = headers.select("local_path", *(F.col(c).alias(f"_h_{c}") for c in names))
    both = assets.join(h, "local_path", "left")
    return both.select(*(F.coalesce(F.col(f"_h_{c}"), F.col(c)).alias(c) if c in names else F.col(c) for c in assets.columns))


def upsert_runs(old: DataFrame, new: DataFrame) -> DataFrame:
    """U07"""
    return upsert(old, new, ["state_db", "run_id"])


def replace_images(images: DataFrame, new: DataFrame, source_type: str = "L1C") -> DataFrame:
    """All images of the items in ``new`` but their input give way to the new ones."""
    items = new.select("item_id").distinct()
    kept = images.filter(F.col("image_type") == source_type).unionByName(images.filter(F.col("image_type") != source_type).join(items, "item_id", "left_anti"))
    return kept.unionByName(new)


def assets_to_repair(assets: DataFrame, inventory: DataFrame) -> DataFrame:
    """Completed assets whose file is missing or has another or an unknown size."""
    both = assets.filter("status = 'completed'").join(inventory.select(F.col("path").alias("local_path"), "length"), "local_path", "left")
    reason = F.when(F.col("length").isNull(), "missing").when(F.col("bytes").isNull(), "unknown-size").when(F.col("length") != F.col("bytes"), "size-mismatch")
    return both.withColumn("reason", reason).filter("reason is not null").select("item_id", "asset_key", "local_path", "reason")


def requeue(jobs: DataFrame, assets: DataFrame, repair: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Jobs and assets after the repair list is queued anew."""
    broken = repair.select("item_id", "asset_key").distinct().withColumn("_bad", F.lit(True))
    a = assets.join(broken, ["item_id", "asset_key"], "left").withColumn("status", F.when(F.col("_bad"), F.lit("queued")).otherwise(F.col("status"))).drop("_bad")
    j = jobs.join(broken.select("item_id").distinct().withColumn("_bad", F.lit(True)), "item_id", "left").withColumn("status", F.when(F.col("_bad"), F.lit("queued")).otherwise(F.col("status"))).drop("_bad")
    return j.select(*jobs.columns), a.select(*assets.columns)


def recover_interrupted(df: DataFrame) -> DataFrame:
    """What was being processed is queued."""
    return df.withColumn("status", F.when(F.col("status") == "processing", F.lit("queued")).otherwise(F.col("status")))


def requeue_terminal(jobs: DataFrame, assets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Failed and retired jobs start anew, with their assets that are not complete."""
    over = F.col("status").isin("failed", "retired")
    items = jobs.filter(over).select("item_id").distinct().withColumn("_again", F.lit(True))
    j = jobs.withColumns({"attempts": F.when(over, F.lit(0)).otherwise(F.col("attempts")), "status": F.when(over, F.lit("queued")).otherwise(F.col("status"))})
    again = F.col("_again").isNotNull() & (F.col("status") != "completed")
    a = assets.join(items, "item_id", "left").withColumns({"attempts": F.when(again, F.lit(0)).otherwise(F.col("attempts")), "status": F.when(again, F.lit("queued")).otherwise(F.col("status"))})
    return j.select(*jobs.columns), a.select(*assets.columns)
