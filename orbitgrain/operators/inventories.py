"""Inventories compared from the top of a hash tree, so that what did not change is not read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orbitgrain.operators.audit import reconcile

LEVELS = ("month", "day", "product")
FILES = "product string, path string, size long, sha256 string, day string, month string"
TREE = "month string, day string, product string, n long, h1 decimal(38,0), h2 decimal(38,0), level string"


def _nodes(files: DataFrame, by: list[str]) -> DataFrame:
    """(by, n, h1, h2): how many files and two sums of their hashes, which do not depend on their order and combine before the shuffle."""
    return files.groupBy(*by).agg(F.sum("n").alias("n"), F.sum("h1").alias("h1"), F.sum("h2").alias("h2"))


def hash_tree(files: DataFrame) -> DataFrame:
    """(level, month, day, product, n, h1, h2) of files (month, day, product, path, size, sha256): each level is summed from the one below.

    Levels without a name at a node are null there. Two branches with equal
    numbers have, but for chance, the same files; repeated rows count.
    """
    row = [F.coalesce(F.col(c).cast("string"), F.lit("\x00")) for c in ("path", "size", "sha256")]
    leaf = files.select(*LEVELS, F.lit(1).cast("long").alias("n"), *(F.xxhash64(F.lit(seed), *row).cast("decimal(38,0)").alias(h) for h, seed in (("h1", 1), ("h2", 2))))
    products = _nodes(leaf, list(LEVELS))
    days = _nodes(products, ["month", "day"])
    months = _nodes(days, ["month"])
    out = None
    for name, nodes in (("product", products), ("day", days), ("month", months)):
        nodes = nodes.withColumn("level", F.lit(name))
        out = nodes if out is None else out.unionByName(nodes, allowMissingColumns=True)
    return out.select("level", *LEVELS, "n", *(F.col(h).cast("decimal(38,0)").alias(h) for h in ("h1", "h2")))


def write_inventory(files: DataFrame, path: str) -> None:
    """Files in folders by month and in order of days, with their tree beside them, partitioned by level.

    Tasks write ranges of days (a day of very many files is several), so there
    are few files in all, and a scan for some days skips the other ones by
    their bounds. ``files`` is read three times; set it down first where it is dear to make.
    """
    files = files.select(*(F.col(f.split()[0]).cast(f.split()[1]) for f in FILES.split(", ")))
    files.repartitionByRange("month", "day", F.xxhash64("path")).sortWithinPartitions("month", "day").write.mode("overwrite").partitionBy("month").parquet(f"{path}/files")
    hash_tree(files).write.mode("overwrite").partitionBy("level").parquet(f"{path}/tree")


def differing(expected: DataFrame, present: DataFrame, level: str) -> DataFrame:
    """Nodes of a level of two trees that are not the same or are on one side only."""
    keys = list(LEVELS[: LEVELS.index(level) + 1])
    e, p = (t.filter(F.col("level") == level).select(*keys, F.struct("n", "h1", "h2").alias(name)) for t, name in ((expected, "_e"), (present, "_p")))
    p = p.withColumnsRenamed({k: f"_{k}" for k in keys})
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
    both = e.join(p, same, "full_outer").filter(~F.col("_e").eqNullSafe(F.col("_p")))
    return both.select(*(F.when(F.col("_e").isNotNull(), F.col(k)).otherwise(F.col(f"_{k}")).alias(k) for k in keys))


def reconcile_inventories(spark: SparkSession, expected: str, present: str) -> DataFrame:
    """(month, day, product, path, class) of the files of products that differ; all other files are ok.

    The trees are compared by month; only trees' days of differing months are
    compared then, and only files of differing days are read, of which those of
    differing products are joined. The numbers of differing days come to the
    driver, to name them to the scan: at most one a calendar day.
    """
    trees = [spark.read.schema(TREE).parquet(f"{p}/tree") for p in (expected, present)]
    months = [r.month for r in differing(*trees, "month").collect()]
    some = [t.filter(F.col("month").isin(months)) for t in trees]
    days = [(r.month, r.day) for r in differing(*some, "day").collect()]
    near = F.lit(False)
    for m in sorted({m for m, _ in days}):
        near = near | ((F.col("month") == m) & F.col("day").isin(sorted(d for x, d in days if x == m)))
    products = differing(*(t.filter(near) for t in trees), "product")
    files = [spark.read.schema(FILES).parquet(f"{p}/files").filter(near).join(products, list(LEVELS), "left_semi") for p in (expected, present)]
    return reconcile(*files, (*LEVELS, "path"))
