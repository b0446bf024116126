"""Comparison of sources and masks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orbitgrain.functions.masks import INDICES, mask_layers
from orbitgrain.operators.quantiles import exact_quantiles
from orbitgrain.session import scratch_path


def long_indices(composites: DataFrame, keys=("source",), indices=tuple(INDICES)) -> DataFrame:
    """One row for each cell and index."""
    return composites.unpivot([*keys, "cx", "cy"], list(indices), "index", "v")


def band_statistics(values: DataFrame, keys=("source", "index")) -> DataFrame:
    """A04"""
    return values.groupBy(*keys).agg(F.count("v").alias("valid"), F.min("v").alias("minimum"), F.max("v").alias("maximum"), F.avg("v").alias("mean"), F.stddev_pop("v").alias("stddev"))


def histogram(values: DataFrame, keys=("source", "index"), bins: int = 64, low: float = -1.0, high: float = 1.0) -> DataFrame:
    """Dense bins; the top edge belongs to the last bin; values outside are counted apart."""
    if bins < 16:
        raise ValueError("at least 16 bins")
    width = (high - low) / bins
    v = F.col("v")
    inside = v.between(low, high)
    number = F.when(inside, F.least(F.floor((v - low) / width), F.lit(bins - 1)).cast("int"))
    counted = values.filter("v is not null").groupBy(*keys, number.alias("bin")).agg(F.count(F.lit(1)).alias("n"), F.count_if(v < low).alias("under"), F.count_if(v > high).alias("over"))
    totals = counted.groupBy(*keys).agg(F.sum(F.when(F.col("bin").isNotNull(), F.col("n")).otherwise(0)).alias("in_range"), F.sum("under").alias("underflow"), F.sum("over").alias("overflow"))
    dense = totals.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    both = dense.join(counted.select(*keys, "bin", "n"), [*keys, "bin"], "left").fillna(0, ["n"])
    density = F.when(F.col("in_range") > 0, F.col("n") / F.col("in_range") / width).otherwise(0.0)
    return both.select(*keys, "bin", "n", density.alias("density"), "underflow", "overflow")


def coverage(values: DataFrame, roi_cells: int | Column, keys=("source", "index")) -> DataFrame:
    """Percent of the region's cells with a value, and the rest."""
    roi = roi_cells if isinstance(roi_cells, Column) else F.lit(roi_cells)
    out = values.groupBy(*keys).agg(F.count("v").alias("valid"))
    percent = F.when(roi > 0, F.least(F.lit(100.0), F.col("valid") / roi * 100)).otherwise(0.0)
    return out.withColumn("coverage_pct", percent).withColumn("masked_pct", 100 - F.col("coverage_pct"))


def mask_table(pixels: DataFrame, kinds: dict[str, str]) -> DataFrame:
    """(source, date, cx, cy, layers) over several sources; kinds: source -> kind of mask.

    A cell seen twice on a date counts as flagged if it was flagged once.
    """
    layers = list(mask_layers("scl"))
    parts = [pixels.filter(F.col("source") == s).select("source", F.to_date("acquired").alias("date"), "cx", "cy", *(c.alias(n) for n, c in mask_layers(k).items())) for s, k in kinds.items()]
    return reduce(DataFrame.unionByName, parts).groupBy("source", "date", "cx", "cy").agg(*(F.bool_or(n).alias(n) for n in layers))


def flag_of(source: Column, buffered: str) -> Column:
    """Cloud or shadow, with the buffer for the source that has one."""
    return F.col("cloud") | F.col("shadow") | ((source == buffered) & F.col("buffer"))


def mask_pairs(masks: DataFrame, pairs: list[tuple[str, str]], flag: Column) -> DataFrame:
    """Cells of the same date in both sources of a pair: (pair, date, cx, cy, a, b)."""
    flags = masks.select("source", "date", "cx", "cy", flag.alias("f"))
    wide = flags.groupBy("date", "cx", "cy").pivot("source", sorted({s for p in pairs for s in p})).agg(F.first("f"))
    rows = F.array(*(F.struct(F.lit(f"{a}_{b}").alias("pair"), F.col(a).alias("a"), F.col(b).alias("b")) for a, b in pairs))
    return wide.select("date", "cx", "cy", F.explode(rows).alias("r")).select("date", "cx", "cy", "r.*").filter("a is not null and b is not null")


def confusion(pairs: DataFrame, keys=("pair", "date")) -> DataFrame:
    """A07"""
    a, b = F.col("a"), F.col("b")
    return pairs.groupBy(*keys).agg(F.count_if(a & b).alias("both"), F.count_if(a & ~b).alias("first_only"), F.count_if(~a & b).alias("second_only"), F.count_if(~a & ~b).alias("neither"))


def pooled(counts: DataFrame, keys=("pair",)) -> DataFrame:
    """Counts over all dates."""
    return counts.groupBy(*keys).agg(*(F.sum(c).alias(c) for c in ("both", "first_only", "second_only", "neither")))


def agreement(counts: DataFrame) -> DataFrame:
    """Percent agreement, intersection over union (1 without a flag), kappa (1 if chance alone agrees)."""
    both, first, second, neither = (F.col(c).cast("double") for c in ("both", "first_only", "second_only", "neither"))
    n = both + first + second + neither
    p1, p2 = (both + first) / n, (both + second) / n
    observed, expected = (both + neither) / n, p1 * p2 + (1 - p1) * (1 - p2)
    either = both + first + second
    return counts.filter(F.col("both") + F.col("first_only") + F.col("second_only") + F.col("neither") > 0).withColumns({
        "agreement_pct": 100 * observed,
        "iou": F.when(either > 0, both / either).otherwise(1.0),
        "kappa": F.when(expected < 1, (observed - expected) / F.when(expected < 1, 1 - expected)).otherwise(1.0),
    })


def flagged_shares(counts: DataFrame) -> DataFrame:
    """Percent flagged by both, the first, the second."""
    n = F.col("both") + F.col("first_only") + F.col("second_only") + F.col("neither")
    return counts.withColumns({"both_pct": F.col("both") * 100.0 / n, "first_pct": (F.col("both") + F.col("first_only")) * 100.0 / n, "second_pct": (F.col("both") + F.col("second_only")) * 100.0 / n})


def mean_agreement(by_date: DataFrame) -> DataFrame:
    """A10"""
    return by_date.groupBy("pair").agg(F.avg("agreement_pct").alias("agreement_pct"), F.avg("iou").alias("iou"), F.avg("kappa").alias("kappa"), F.count(F.lit(1)).alias("dates"))


def index_pairs(values: DataFrame, sources: list[str], land: DataFrame | None = None) -> DataFrame:
    """For each ordered pair of sources the cells both have: (pair, index, x, y); ``land`` (cx, cy) restricts them."""
    if land is not None:
        values = values.join(land.select("cx", "cy").distinct(), ["cx", "cy"], "left_semi")
    wide = values.groupBy("cx", "cy", "index").pivot("source", sources).agg(F.first("v"))
    named = [F.struct(F.lit(f"{b}_minus_{a}").alias("pair"), F.col(a).alias("x"), F.col(b).alias("y")) for i, a in enumerate(sources) for b in sources[i + 1 :]]
    return wide.select("index", F.explode(F.array(*named)).alias("r")).select("index", "r.*").filter("x is not null and y is not null")


def difference_statistics(pairs: DataFrame, cells: int | Column) -> DataFrame:
    """A11; the pairs are set down, since the exact median reads them again."""
    path = scratch_path(pairs.sparkSession, "pairs")
    pairs.write.parquet(path)
    pairs, d = pairs.sparkSession.read.schema(pairs.schema).parquet(path), F.col("y") - F.col("x")
    keys = ["pair", "index"]
    means = pairs.groupBy(*keys).agg(
        (F.count(F.lit(1)) * 100.0 / cells).alias("common_valid_pct"), F.avg(d).alias("mean_difference"), F.sqrt(F.avg(d * d)).alias("rmsd"),
        F.avg(F.abs(d)).alias("mean_absolute_difference"), F.corr("x", "y").alias("pearson_r"), (F.avg((F.abs(d) > 0.1).cast("int")) * 100).alias("above_0_1_pct"),
    )
    middle = exact_quantiles(pairs.withColumn("d", d), keys, "d", [0.5]).select(*keys, F.get("q", 0).alias("median_difference"))
    return means.join(middle, keys)


def observation_counts(masks: DataFrame, grid: DataFrame) -> DataFrame:
    """Clear looks of each cell of the grid (cx, cy) and source; 0 where there is none. A null source has no row."""
    clear = masks.groupBy("source", "cx", "cy").agg(F.count_if(~F.col("route_invalid")).alias("clear"))
    sources = masks.agg(F.array_sort(F.collect_set("source")).alias("_sources"))  # one row with a handful of names
    every = grid.crossJoin(F.broadcast(sources)).select("*", F.explode("_sources").alias("source")).drop("_sources")
    return every.join(clear, ["source", "cx", "cy"], "left").fillna(0, ["clear"])


def observation_summary(counts: DataFrame) -> DataFrame:
    """A13"""
    return counts.groupBy("source").agg(F.avg("clear").alias("mean_clear"), (F.avg((F.col("clear") == 0).cast("int")) * 100).alias("none_pct"), (F.avg((F.col("clear") >= 3).cast("int")) * 100).alias("three_or_more_pct"))


def flag_percentages(masks: DataFrame) -> DataFrame:
    """By date and source."""
    flags = {"cloud": F.col("cloud"), "shadow": F.col("shadow"), "cloud_or_shadow": F.col("cloud") | F.col("shadow"), "invalid": F.col("route_invalid"), "buffer": F.col("buffer")}
    return masks.groupBy("date", "source").agg(*((F.avg(c.cast("int")) * 100).alias(f"{n}_pct") for n, c in flags.items()))


def wide_percentages(percentages: DataFrame, sources: list[str], column: str = "cloud_or_shadow_pct") -> DataFrame:
    """A column for each source."""
    return percentages.groupBy("date").pivot("source", sources).agg(F.first(column))


def common_date_means(percentages: DataFrame, n_sources: int) -> DataFrame:
    """Means over the dates that every source has."""
    dates = percentages.groupBy("date").agg(F.count_distinct("source").alias("n")).filter(F.col("n") == n_sources).select("date")
    names = [c for c in percentages.columns if c.endswith("_pct")]
    return percentages.join(dates, "date", "left_semi").groupBy("source").agg(F.count(F.lit(1)).alias("dates"), *(F.avg(c).alias(c) for c in names))


# Stages whose times add up to the monthly mosaic where it is not given.
STAGES = (
    "force_qai_screening", "monthly_compositing", "national_clipping_and_cog", "scene_masking", "tile_compositing",
    "country_mosaicking", "remote_cog_alignment", "quality_mask_and_reflectance_cog",
)


def normal_timings(manifests: DataFrame) -> DataFrame:
    """Manifests (product, timings map<string,double>) to three times and a problem, if there is one."""
    at = lambda k: F.try_element_at(F.col("timings"), F.lit(k))
    some = reduce(lambda a, b: a | b, (at(k).isNotNull() for k in STAGES))
    stages = sum((F.coalesce(at(k), F.lit(0.0)) for k in STAGES), F.lit(0.0))
    out = manifests.select("product", F.coalesce(at("monthly_mosaic_generation"), F.when(some, stages)).alias("mosaic_s"), at("index_calculation").alias("index_s"), at("total").alias("total_s"))
    times = [F.col(c) for c in ("mosaic_s", "index_s", "total_s")]
    bad = reduce(lambda a, b: a | b, (F.isnan(t) | (F.abs(t) == float("inf")) | (t < 0) for t in times))
    problem = F.when(F.col("mosaic_s").isNull(), "no-mosaic-timing").when(F.col("index_s").isNull() | F.col("total_s").isNull(), "no-index-or-total-timing").when(bad, "not-finite-or-negative").when(F.col("total_s") + 0.01 < F.col("mosaic_s") + F.col("index_s"), "total-shorter-than-parts")
    return out.withColumn("problem", problem)


def timing_report(stages: DataFrame, sources: list[str]) -> DataFrame:
    """(source, stage, seconds) to minutes side by side."""
    return stages.groupBy("stage").pivot("source", sources).agg(F.sum(F.col("seconds") / 60))


def missing_products(products: DataFrame, sources: list[str], months: list[int]) -> DataFrame:
    """(source, month, reason) of the grid's places without exactly one product; the grid is a handful of rows."""
    grid = products.sparkSession.createDataFrame([(s, m) for s in sources for m in months], "source string, month int")
    n = products.groupBy("source", F.col("month").cast("int").alias("month")).agg(F.count(F.lit(1)).alias("n"))
    both = grid.join(n, ["source", "month"], "left").fillna(0, ["n"])
    return both.filter("n <> 1").select("source", "month", F.when(F.col("n") == 0, "missing").otherwise("duplicate").alias("reason"))


def provenance_match(products: DataFrame, first: str, second: str) -> DataFrame:
    """(product, side, platform, sensing, orbit, tile) compared as sets: matched, mismatched or not available."""
    own = lambda s: F.array_sort(F.collect_set(F.when(F.col("side") == s, F.struct("platform", "sensing", "orbit", "tile"))))
    sets = products.groupBy("product").agg(own(first).alias("a"), own(second).alias("b"))
    return sets.select("product", F.when((F.size("a") == 0) | (F.size("b") == 0), "not-available").when(F.col("a") == F.col("b"), "matched").otherwise("mismatched").alias("match"))
