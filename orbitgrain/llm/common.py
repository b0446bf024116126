"""Small helpers that several operators of this subpackage share."""

from __future__ import annotations

import gc
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Words of the contracts: runs of anything but ASCII white space.
WORD_CLASS = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(text, UPPER, UPPER.lower())


def key_crc(key: Column) -> Column:
    """crc32 of the key written as text; null keys count as empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary"))


def texts_of(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    """Texts of a batch, null as empty."""
    return ["" if t is None else t for t in batch.column(name).to_pylist()]


def map_texts(df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch | None]], schema: str) -> DataFrame:
    """Run ``make()`` once per task and what it returns on each Arrow batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = make()
        for batch in batches:
            if batch.num_rows and (out := step(batch)) is not None:
                yield out

    return df.mapInArrow(run, schema)


def scratch_folder(spark: SparkSession, label: str) -> str:
    """A new folder's path in the shared folder of the session."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir") + "/cuts"
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str = "cut") -> DataFrame:
    """Cut the lineage with a table in the shared folder of the session.

    The folder is ``spark.checkpoint.dir``; only where that is unset (local
    runs) a folder below the warehouse is used. Shuffle files of what led
    here are no longer referenced afterwards.
    """
    path = scratch_folder(df.sparkSession, label)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.cut_at = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete tables of ``materialize``; whatever was made of them must have been set down itself."""
    for t in tables:
        spark = t.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(t.cut_at)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def drop_unused(spark: SparkSession) -> None:
    """Let Spark's cleaner remove shuffle files that nothing refers to."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def least_hashed(rows: DataFrame, most: int, longest: int = 100_000) -> DataFrame:
    """(text) of at most ``most`` rows (doc_id, text) with a text, those with the least hash of doc_id, equal texts once.

    Of a text of over ``longest`` characters the whole words among so many stand
    for it, from a place that its doc_id's hash tells. Hashes are ranked without their texts, which
    are read for the chosen rows.
    """
    some = rows.filter("length(text) > 0").select("text", F.xxhash64("doc_id").alias("h"))
    last = some.select("h").distinct().orderBy("h").limit(most).agg(F.max("h")).first()[0]
    chosen = some.filter(F.col("h") <= last) if last is not None else some.limit(0)
    spare = F.length("text") - longest
    slice_ = F.substring("text", F.pmod("h", F.greatest(spare, F.lit(1))).cast("int") + 1, F.lit(longest))
    part = F.when(spare > 0, F.regexp_extract(slice_, r"(?s)^\S*+(\s.*)\s\S*+$", 1)).otherwise(F.col("text"))
    return chosen.select(part.alias("text")).filter("length(text) > 0").distinct().orderBy(F.xxhash64("text"), "text").limit(most)


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64 on an unsigned 64-bit array."""
    x = x.astype(np.uint64, copy=True)
    with np.errstate(over="ignore"):
        x ^= x >> np.uint64(30)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(27)
        x *= np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
    return x
