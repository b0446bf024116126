"""Sharding by best-fit-decreasing bin packing of indivisible groups.

Two levels keep it distributed. Groups (equal texts) are dealt by hash to
cells; in a cell, sorted by size, each enters the open pack with the tightest
remaining capacity, found in a balanced tree. Packs and groups larger than a
pack, a bounded number, are then packed the same way into the shards, with
the smallest capacity that needs no more shards than asked for.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orbitgrain.llm.common import materialize, table


class RemainingTree:
    """Open bins ordered by remaining capacity: a B-tree of two levels.

    Leaves are sorted lists of at most ``width`` (remaining, bin) pairs; a leaf
    that overflows is halved, an empty one is removed.
    """

    def __init__(self, width: int = 64):
        self.width, self.leaves, self.tops = width, [], []

    def _leaf(self, key: tuple[int, int]) -> int:
        import bisect

        return min(bisect.bisect_left(self.tops, key), max(0, len(self.leaves) - 1))

    def add(self, key: tuple[int, int]) -> None:
        import bisect

        if not self.leaves:
            self.leaves, self.tops = [[key]], [key]
            return
        i = self._leaf(key)
        leaf = self.leaves[i]
        bisect.insort(leaf, key)
        self.tops[i] = leaf[-1]
        if len(leaf) > self.width:
            half = len(leaf) // 2
            self.leaves[i : i + 1] = [leaf[:half], leaf[half:]]
            self.tops[i : i + 1] = [leaf[half - 1], leaf[-1]]

    def take(self, size: int) -> tuple[int, int] | None:
        """Remove and return the pair with the least remaining >= size."""
        import bisect

        key = (size, -1)
        i = bisect.bisect_left(self.tops, key)
        if i == len(self.tops):
            return None
        leaf = self.leaves[i]
        found = leaf.pop(bisect.bisect_left(leaf, key))
        if leaf:
            self.tops[i] = leaf[-1]
        else:
            del self.leaves[i], self.tops[i]
        return found


def best_fit_decreasing(sizes: list[int], capacity: int) -> tuple[list[int], int]:
    """Bin of each item (in the given order) and the number of bins.

    Ties in size keep the given order; ties in remaining capacity go to the
    older bin. An item larger than ``capacity`` gets a bin of its own.
    """
    tree, out, bins = RemainingTree(), [0] * len(sizes), 0
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        found = tree.take(sizes[i])
        if found is None:
            found = (max(capacity, sizes[i]), bins)
            bins += 1
        out[i] = found[1]
        tree.add((found[0] - sizes[i], found[1]))
    return out, bins


def pack_into(sizes: list[int], n_bins: int) -> list[int]:
    """Best-fit decreasing with the smallest capacity that needs ``n_bins``."""
    if not sizes:
        return []
    low = max(max(sizes), math.ceil(sum(sizes) / n_bins))
    high, best = low, None
    while best is None:
        out, used = best_fit_decreasing(sizes, high)
        best = out if used <= n_bins else None
        high = high if best else high + max(1, high // 64)
    while low < high:
        mid = (low + high) // 2
        out, used = best_fit_decreasing(sizes, mid)
        if used <= n_bins:
            best, high = out, mid
        else:
            low = mid + 1
    return best


def shard_by_size(rows: DataFrame, n_shards: int = 16, packs_per_shard: int = 256, hot_share: int = 1000) -> DataFrame:
    """Adds ``shard`` and ``slot`` to rows (doc_id, size, group_key, ...).

    Rows with one ``group_key`` stay together; sizes of shards are near equal
    unless one group exceeds an equal share. ``slot`` counts from 0 without
    gaps in a shard. Null ``group_key`` is a group of its own. Empty input
    gives no rows. Repeated rows each get a slot.
    """
    spark = rows.sparkSession
    rows = rows.withColumn("group_key", F.coalesce(F.col("group_key"), F.lit("")))
    groups = rows.groupBy("group_key").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("copies"))
    groups = materialize(groups, "groups")  # narrow: a key and two numbers for each group
    total = groups.agg(F.sum("bytes").alias("b"), F.sum("copies").alias("n"), F.count(F.lit(1)).alias("g")).first()
    bytes_, n, g = total.b or 0, total.n or 0, total.g or 0
    # more packs for more groups, so that a cell holds a bounded number; the driver sees at most about 2 * n_packs items
    n_packs = min(max(n_shards * packs_per_shard, g // 2000), 262_144)
    pack_size = max(1, bytes_ // n_packs)
    n_cells = max(1, n_packs // 16)
    schema = "group_key string, cell int, pack int, bytes long"

    def pack_cell(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("group_key", kind="stable")
        pdf["pack"], _ = best_fit_decreasing(pdf["bytes"].tolist(), pack_size)
        return pdf[["group_key", "cell", "pack", "bytes"]]

    small = groups.filter(F.col("bytes") <= pack_size).select("group_key", "bytes", F.pmod(F.xxhash64("group_key"), F.lit(n_cells)).cast("int").alias("cell")).groupBy("cell").applyInPandas(pack_cell, schema)
    small = materialize(small, "packs")
    large = groups.filter(F.col("bytes") > pack_size).select("group_key", F.lit(-1).alias("cell"), F.lit(0).alias("pack"), "bytes")
    packs = small.groupBy("cell", "pack").agg(F.sum("bytes").alias("bytes")).select("cell", "pack", "bytes", F.lit("").alias("group_key")).unionByName(large)
    items = sorted(((r.bytes, r.cell, r.pack, r.group_key) for r in packs.collect()), key=lambda x: (-x[0], x[1:]))
    shards = pack_into([i[0] for i in items], n_shards)
    placed = spark.createDataFrame([(c, p, k, s) for (_, c, p, k), s in zip(items, shards, strict=True)], "cell int, pack int, large_key string, shard int")
    of_small = small.join(F.broadcast(placed.filter("cell >= 0").drop("large_key")), ["cell", "pack"]).select("group_key", "shard")
    of_large = placed.filter("cell < 0").select(F.col("large_key").alias("group_key"), "shard")
    # the few groups with many copies are looked up, the rest are joined
    hot = groups.filter(F.col("copies") > max(100, n // hot_share)).select("group_key")
    where = of_small.unionByName(of_large)
    hot_where = F.broadcast(where.join(F.broadcast(hot), "group_key", "left_semi").withColumnRenamed("shard", "hot_shard"))
    first = rows.join(hot_where, "group_key", "left")
    cold = first.filter("hot_shard is null").drop("hot_shard").join(where, "group_key")
    sharded = cold.unionByName(first.filter("hot_shard is not null").withColumnRenamed("hot_shard", "shard").select(cold.columns))
    return with_slots(sharded, n, n_shards)


def with_slots(sharded: DataFrame, n: int, n_shards: int, rows_per_bucket: int = 20_000) -> DataFrame:
    """Gapless ``slot`` in each shard: buckets by hash, offsets of buckets, then ranks within them."""
    n_buckets = min(max(8, n // (n_shards * rows_per_bucket) + 1), 4096)  # at most 65,536 offsets for 16 shards
    bucketed = sharded.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "size"), F.lit(n_buckets)).cast("int"))
    counts = bucketed.groupBy("shard", "bucket").agg(F.count(F.lit(1)).alias("rows"))
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("shard", "bucket", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("offset"))
    within = Window.partitionBy("shard", "bucket").orderBy("doc_id", "text_crc32")
    ranked = bucketed.withColumn("rank", F.row_number().over(within) - 1)
    return ranked.join(F.broadcast(offsets), ["shard", "bucket"]).withColumn("slot", F.col("offset") + F.col("rank")).drop("bucket", "offset", "rank")


def documents_to_shards(docs: DataFrame, n_shards: int = 16) -> DataFrame:
    """Shards of documents (doc_id, text), equal texts together.

    size is the text's UTF-8 bytes plus 1; null text has size 1 and checksum 0
    and goes with empty text. Other columns are ignored.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.sha2(text.cast("binary"), 256).alias("group_key"),
    )
    return shard_by_size(rows, n_shards)


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in shards 0 to 15 under the law ``bytes``."""
    out = documents_to_shards(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
