"""Durable progress: an append-only log of what is finished, and tables that batches change bucket by bucket."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class CommitLog:
    """Records appended below a folder that Spark reaches, one file each.

    A record is there once its file has its name, which the committer gives it
    in one step; a writer that dies before leaves nothing that is read.
    Records are few: one a batch, window or group of tiles.
    """

    def __init__(self, spark: SparkSession, path: str, schema: str):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema

    def _exists(self) -> bool:
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        return folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(folder)

    def read(self) -> DataFrame:
        """All records; none where nothing was ever appended."""
        return self.spark.read.schema(self.schema).parquet(self.path) if self._exists() else self.spark.createDataFrame([], self.schema)

    def append(self, rows: DataFrame | list[tuple]) -> None:
        rows = self.spark.createDataFrame(rows, self.schema) if isinstance(rows, list) else rows
        rows.coalesce(1).write.mode("append").parquet(self.path)


class KeyedTable:
    """A table of rows by key in hash buckets, of which a batch rewrites those that hold its keys.

    A batch goes through three steps, each of which can be done again: the new
    state of the touched buckets is set down beside the table, the table's
    buckets are overwritten from there (dynamic partition overwrite, others
    keep their files), and the batch's number goes into the log. A batch in the
    log is not applied again; one that was set down whole but not logged is
    overwritten from what was set down, never merged twice.
    """

    STATES = "batch_id long, step string"

    def __init__(self, spark: SparkSession, path: str, schema: str, key: str, buckets: int = 64):
        self.spark, self.key, self.buckets = spark, key, buckets
        self.table, self.staged, self.schema = f"{path.rstrip('/')}/table", f"{path.rstrip('/')}/staged", schema
        self.log = CommitLog(spark, f"{path.rstrip('/')}/log", self.STATES)

    def _exists(self, path: str) -> bool:
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(p)

    def _bucket(self):
        return F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")

    def _stored(self) -> DataFrame:
        whole = f"{self.schema}, bucket int"
        return self.spark.read.schema(whole).parquet(self.table) if self._exists(self.table) else self.spark.createDataFrame([], whole)

    def read(self) -> DataFrame:
        return self._stored().drop("bucket")

    def applied(self, batch_id: int) -> bool:
        return bool(self.log.read().filter((F.col("batch_id") == batch_id) & (F.col("step") == "applied")).limit(1).collect())

    def apply(self, batch: DataFrame, batch_id: int, merge: Callable[[DataFrame, DataFrame], DataFrame], keys: DataFrame | None = None) -> bool:
        """Merge a batch with the buckets it touches; False if it was applied before.

        ``merge(old, new)`` gives the rows of the touched buckets; it keeps the
        keys it is given, since a bucket left without rows is not overwritten.
        The numbers
        of touched buckets, at most ``buckets``, come to the driver, so that
        the scan reads their folders only; they are told from ``keys``, which
        has the batch's keys in any number of rows, where working out the batch
        itself costs more. A large bucket is written by several tasks.
        """
        done = {r.step for r in self.log.read().filter(F.col("batch_id") == batch_id).collect()}
        if "applied" in done:
            return False
        staged = f"{self.staged}/{batch_id}"
        if "staged" not in done:
            touched = sorted(r.bucket for r in (batch if keys is None else keys).select(self._bucket().alias("bucket")).distinct().collect())
            old = self._stored().filter(F.col("bucket").isin(touched)).drop("bucket") if touched else self.read().limit(0)
            merged = merge(old, batch).withColumn("bucket", self._bucket())
            merged.write.mode("overwrite").parquet(staged)
            self.log.append([(batch_id, "staged")])
        rows = self.spark.read.schema(f"{self.schema}, bucket int").parquet(staged)
        rows.hint("rebalance", "bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(self.table)
        self.log.append([(batch_id, "applied")])
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(staged)
        folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(folder, True)
        return True

    def each(self, merge: Callable[[DataFrame, DataFrame], DataFrame]) -> Callable[[DataFrame, int], None]:
        """A foreachBatch step."""
        return lambda batch, batch_id: self.apply(batch, batch_id, merge)


ASSETS = "item_id long, asset_key string, href string, local_path string, status string, attempts int, bytes long, sha256 string, last_error string"
JOBS = "item_id long, item_datetime timestamp, status string, attempts int, next_attempt_at timestamp, last_error string, requested_assets array<string>, missing_assets array<string>"


def requeue_changed(assets: KeyedTable, jobs: KeyedTable) -> Callable[[DataFrame, int], None]:
    """A foreachBatch step for items seen again: rows (item_id, item_datetime, asset_key, href, local_path, requested_assets, missing_assets).

    An asset with another href or path is queued anew (U02), a job with other
    requested or missing assets starts anew (U03), and one of whose assets any
    moved or is new is queued with its attempts kept. Jobs are settled before
    assets, from the assets as they were, so a batch that stopped in between
    goes on with the assets alone. Of an asset's rows in a batch the greatest
    href counts, of an item's the latest time. The batch is set down beside the
    jobs until both are done, so that what it is made of is worked out once.
    """
    from orbitgrain.operators.upserts import upsert_assets, upsert_jobs

    def step(batch: DataFrame, batch_id: int) -> None:
        if jobs.applied(batch_id) and assets.applied(batch_id):
            return
        spark, held = batch.sparkSession, f"{jobs.staged}-seen/{batch_id}"
        batch.filter(F.col("item_id").isNotNull()).write.mode("overwrite").parquet(held)
        named = spark.read.schema(batch.schema).parquet(held)
        own = named.filter(F.col("asset_key").isNotNull()).groupBy("item_id", "asset_key").agg(F.max(F.struct("href", "local_path")).alias("place")).select("item_id", "asset_key", "place.*")
        items = named.groupBy("item_id").agg(F.max(F.struct("item_datetime", "requested_assets", "missing_assets")).alias("r")).select("item_id", "r.*")

        def settle(old: DataFrame, new: DataFrame) -> DataFrame:
            known = assets.read().select("item_id", "asset_key", F.col("href").alias("_href"), F.col("local_path").alias("_path"), F.lit(True).alias("_known"))
            same = F.coalesce(F.col("_known"), F.lit(False)) & F.col("href").eqNullSafe(F.col("_href")) & F.col("local_path").eqNullSafe(F.col("_path"))
            moved = own.join(known, ["item_id", "asset_key"], "left").groupBy("item_id").agg(F.bool_or(~same).alias("_moved"))
            merged = upsert_jobs(old, new).join(moved, "item_id", "left")
            again = F.coalesce(F.col("_moved"), F.lit(False)) & ~F.col("changed")
            merged = merged.withColumns({"status": F.when(again, F.lit("queued")).otherwise(F.col("status")), "next_attempt_at": F.when(~again, F.col("next_attempt_at")), "last_error": F.when(again, F.lit("a source changed")).otherwise(F.col("last_error"))})
            return merged.select(*old.columns)

        jobs.apply(items, batch_id, settle, named)
        assets.apply(own, batch_id, upsert_assets, named.filter(F.col("asset_key").isNotNull()))
        folder = spark._jvm.org.apache.hadoop.fs.Path(held)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)

    return step


class Backfill:
    """Windows from a start to an end, finished ones recorded, so that a new run goes on behind the last.

    The plan is the first record. A run with another start or width is refused;
    a later end adds windows. Only windows without a gap from the first count.
    """

    SCHEMA = "kind string, first timestamp, last timestamp, days int"

    def __init__(self, spark: SparkSession, path: str, start: datetime, end: datetime, days: int = 1):
        from orbitgrain.streaming.windows import backfill_windows

        self.log, self.windows = CommitLog(spark, path, self.SCHEMA), backfill_windows(start, end, days)
        plan = self.log.read().filter("kind = 'plan'").collect()
        if any((r["first"], r["days"]) != (start, days) for r in plan):
            raise ValueError("the stored plan has another start or width")
        if not plan:
            self.log.append([("plan", start, end, days)])

    def cursor(self) -> datetime | None:
        """End of the last window that is finished with all before it."""
        done, at = {r["first"]: r["last"] for r in self.log.read().filter("kind = 'window'").collect()}, None
        for a, b in self.windows:
            if done.get(a) != b:
                break
            at = b
        return at

    def run(self, process: Callable[[datetime, datetime], bool]) -> datetime | None:
        """``process(first, last)`` from the cursor on, a record after each finished window; stops at one that is not finished.

        ``process`` overwrites its own window's output, since a window whose
        record was not written is processed again.
        """
        from orbitgrain.streaming.windows import run_backfill

        def logged(a: datetime, b: datetime) -> bool:
            ok = process(a, b)
            if ok:
                self.log.append([("window", a, b, (b - a) // timedelta(days=1))])
            return ok

        return run_backfill(self.windows, self.cursor(), logged)


def resume_tiles(source: DataFrame, log: CommitLog, out: str, compute: Callable[[DataFrame], DataFrame], tile: str = "tile_id", overwrite: bool = False) -> DataFrame:
    """The products of all tiles of ``source``; those that the log has are reused, the rest are computed, written and logged.

    Output is partitioned by tile; a tile whose record was not written is
    overwritten, so a run that stops anywhere and starts anew gives the same
    table. ``overwrite`` makes all tiles anew. The log has (tile, at).
    """
    spark, done = source.sparkSession, log.read().select(tile).distinct()
    rest = source if overwrite else source.join(done, tile, "left_anti")
    made = compute(rest)
    made.repartition(tile).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(tile).parquet(out)
    finished = rest.select(tile).distinct().withColumn("at", F.current_timestamp())
    log.append(finished.select(*(f.split()[0] for f in log.schema.split(", "))))
    return spark.read.schema(made.schema).parquet(out)
