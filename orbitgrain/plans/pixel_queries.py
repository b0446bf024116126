"""Queries over pixels: masks, composites, grids, comparison."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orbitgrain.functions import masks as m
from orbitgrain.operators import blocks as tiled
from orbitgrain.operators import compare, composite, grid
from orbitgrain.plans.registry import q

NAMES = m.BANDS
MONTH = "CAST(year(acquired) * 100 + month(acquired) AS BIGINT) AS ym"


def monthly(df: DataFrame) -> DataFrame:
    return df.withColumn("ym", F.year("acquired").cast("long") * 100 + F.month("acquired"))


def rounded(df: DataFrame, *keys: str) -> DataFrame:
    """Doubles to six digits."""
    return df.select(*(F.round(F.col(c), 6).alias(c) if t == "double" and c not in keys else F.col(c) for c, t in df.dtypes))


L2A = "scl NOT IN (0, 1, 3, 8, 9, 10, 11) AND cld BETWEEN 0 AND 30 AND " + " AND ".join(f"{b} * 0.0001e0 - 0.1e0 >= 0" for b in NAMES)
QAI = "(qai & 799) = 0"
V100 = "terrain != 255 AND cloudmask != 255 AND cloudmask != 1 AND terrain != 100"
V200 = "cloudmask = 0 AND terrain < 90"


def screened(condition: str, scale: str, offset: str = "", nodata: int | None = None, names=NAMES, fold: str = "") -> str:
    also = f" AND {{b}} != {nodata}" if nodata is not None else ""
    return ", ".join(f"{fold}(CASE WHEN {condition}{also.format(b=b)} THEN {b} * {scale}{offset} END) AS {b}" for b in names)


def index_sql(digits: bool = True) -> str:
    out = []
    for name, (a, b) in m.INDICES.items():
        x = f"CASE WHEN abs({a} + {b}) > 1e-12 THEN ({a} - {b}) / ({a} + {b}) END"
        out.append(f"round({x}, 6) AS {name}" if digits else f"{x} AS {name}")
    return ", ".join(out)


def round_sql(names=NAMES) -> str:
    return ", ".join(f"round({b}, 6) AS {b}" for b in names)


@q("minimum_slice", f"""
WITH g AS (SELECT {MONTH}, cx, cy, median(CASE WHEN {QAI} THEN b04 * 0.0001e0 END) AS b04, median(CASE WHEN {QAI} THEN b08 * 0.0001e0 END) AS b08 FROM pixels_v GROUP BY 1, 2, 3)
SELECT ym, cx, cy, round(b04, 6) AS b04, round(b08, 6) AS b08, round(CASE WHEN abs(b08 + b04) > 1e-12 THEN (b08 - b04) / (b08 + b04) END, 6) AS ndvi FROM g""")
def _(v):
    return rounded(composite.minimum_slice(monthly(v("pixels_v")), ("ym", "cx", "cy")))


KEY = "item_id, n, cx, cy"


def keyed(df: DataFrame, *names: str) -> DataFrame:
    return rounded(df.select("item_id", "n", "cx", "cy", *names))


@q("m01_reflectance", f"SELECT {KEY}, {', '.join(f'round({b} * 0.0001e0 - 0.1e0, 6) AS {b}' for b in NAMES)} FROM pixels_v")
def _(v):
    return keyed(v("pixels_v").withColumns({b: m.physical(b, 0.0001, -0.1) for b in NAMES}), *NAMES)


@q("m02_scl_cld", f"WITH s AS (SELECT {KEY}, {screened(L2A, '0.0001e0', ' - 0.1e0')} FROM pixels_v) SELECT {KEY}, {round_sql()} FROM s")
def _(v):
    return keyed(m.screen_scl_cld(v("pixels_v")), *NAMES)


@q("m03_qai", f"WITH s AS (SELECT {KEY}, {screened(QAI, '0.0001e0')} FROM pixels_v) SELECT {KEY}, {round_sql()} FROM s")
def _(v):
    return keyed(m.screen_qai(v("pixels_v")), *NAMES)


@q("m04_orbit_v100", f"WITH s AS (SELECT {KEY}, {screened(V100, '0.001e0', '', 9999)} FROM pixels_v) SELECT {KEY}, {round_sql()} FROM s")
def _(v):
    return keyed(m.screen_orbit(v("pixels_v"), m.V100), *NAMES)


@q("m05_orbit_v200", f"WITH s AS (SELECT {KEY}, {screened(V200, '0.0001e0', ' - 0.1e0', 0)} FROM pixels_v) SELECT {KEY}, {round_sql()} FROM s")
def _(v):
    return keyed(m.screen_orbit(v("pixels_v"), m.V200), *NAMES)


@q("m06_mask_parts", f"WITH s AS (SELECT {KEY}, {screened('terrain != 255 AND cloudmask != 255 AND terrain != 100', '0.001e0', '', 9999)} FROM pixels_v) SELECT {KEY}, {round_sql()} FROM s")
def _(v):
    return keyed(m.screen_orbit(v("pixels_v"), m.V100, use_cloud=False), *NAMES)


@q("m07_qai_fields", f"SELECT {KEY}, CAST(qai & 1 AS INT) AS nodata, CAST((qai >> 1) & 3 AS INT) AS cloud_state, CAST((qai >> 3) & 1 AS INT) AS shadow, CAST((qai >> 4) & 1 AS INT) AS snow, CAST((qai >> 8) & 1 AS INT) AS subzero, CAST((qai >> 9) & 1 AS INT) AS saturated FROM pixels_v")
def _(v):
    return keyed(v("pixels_v").withColumns(m.qai_fields(F.col("qai"))), *m.QAI_FIELDS)


# SQL of the mask layers of the three sources
FLAGS = {
    "l2a": ("scl IN (8, 9, 10) OR cld > 30", "scl = 3", "false", "scl IN (0, 1, 3, 8, 9, 10, 11) OR cld > 30"),
    "boa": ("(qai >> 1) & 3 >= 2", "(qai & 8) <> 0", "(qai >> 1) & 3 = 1", "(qai & 799) <> 0"),
    "orbit": ("cloudmask IN (1, 2)", "cloudmask = 3", "false", "cloudmask <> 0 OR terrain >= 90"),
}
KINDS = {"l2a": "scl", "boa": "qai", "orbit": "v200"}
# cells are made coarse here, so that the sources meet
MASKS_SQL = "WITH mk AS (SELECT source, CAST(acquired AS DATE) AS date, cx % 4 AS cx, cy % 2 AS cy, " + ", ".join(
    f"bool_or(CASE source {' '.join(f'''WHEN '{s}' THEN {f[i]}''' for s, f in FLAGS.items())} END) AS {n}" for i, n in enumerate(("cloud", "shadow", "buffer", "invalid"))
) + " FROM pixels_v GROUP BY 1, 2, 3, 4)"


def mask_rows(v) -> DataFrame:
    return compare.mask_table(v("pixels_v").withColumns({"cx": F.col("cx") % 4, "cy": F.col("cy") % 2}), KINDS)


@q("m08_mask_layers", MASKS_SQL.replace("WITH mk", "WITH mk", 1) + " SELECT source, CAST(date AS VARCHAR) AS date, cx, cy, cloud, shadow, buffer, invalid FROM mk")
def _(v):
    return mask_rows(v).select("source", F.col("date").cast("string").alias("date"), "cx", "cy", "cloud", "shadow", "buffer", F.col("route_invalid").alias("invalid"))


@q("m09_three_way_ndvi", f"""
WITH r AS (SELECT {KEY}, scl, cld, qai, (b08 * 0.0001e0 - 0.1e0 - (b04 * 0.0001e0 - 0.1e0)) / nullif(b08 * 0.0001e0 - 0.1e0 + (b04 * 0.0001e0 - 0.1e0), 0) AS x FROM pixels_v)
SELECT {KEY}, round(x, 6) AS ndvi_raw, round(CASE WHEN scl NOT IN (0, 1, 3, 8, 9, 10, 11) AND cld <= 30 THEN x END, 6) AS ndvi_scl, round(CASE WHEN {QAI} THEN x END, 6) AS ndvi_qai FROM r""")
def _(v):
    return keyed(m.three_way_ndvi(v("pixels_v")), "ndvi_raw", "ndvi_scl", "ndvi_qai")


@q("m10_zero_recovery", f"SELECT {KEY}, CASE WHEN item_id % 2 = 0 AND cld = 0 THEN NULL ELSE cld END AS cld FROM pixels_v")
def _(v):
    stored = v("pixels_v").withColumns({"cld": F.when(F.col("cld") != 0, F.col("cld")), "zero": F.col("item_id") % 2 == 1})
    return keyed(stored.withColumn("cld", m.recovered_probability(F.col("cld"), F.col("zero"))), "cld")


@q("m11_indices", f"WITH s AS (SELECT {KEY}, {screened(QAI, '0.0001e0')} FROM pixels_v) SELECT {KEY}, {index_sql()} FROM s")
def _(v):
    return keyed(m.with_indices(m.screen_qai(v("pixels_v"))), *m.INDICES)


def raw_ndvi() -> str:
    return "(b08 - b04) * 1.0e0 / (b08 + b04)"


@q("m12_palette", "WITH x AS (SELECT " + raw_ndvi() + " AS v FROM pixels_v) SELECT CASE " + " ".join(f"WHEN v >= {stop} THEN '{name}'" for stop, _, name in reversed(m.NDVI_STOPS[1:])) + f" ELSE '{m.NDVI_STOPS[0][2]}' END AS class, count(*) AS cells FROM x GROUP BY 1")
def _(v):
    x = v("pixels_v").select(((F.col("b08") - F.col("b04")) / (F.col("b08") + F.col("b04"))).alias("v"))
    return x.groupBy(m.palette_class(F.col("v")).alias("class")).agg(F.count(F.lit(1)).alias("cells"))


@q("m13_false_colour", f"SELECT {KEY}, CAST(least(greatest(round(b08 * 0.0001e0 / 0.8e0 * 255), 0), 255) AS INT) AS red, CAST(least(greatest(round(b04 * 0.0001e0 / 0.5e0 * 255), 0), 255) AS INT) AS green, CAST(least(greatest(round(b03 * 0.0001e0 / 0.5e0 * 255), 0), 255) AS INT) AS blue FROM pixels_v")
def _(v):
    return keyed(m.false_colour(v("pixels_v").withColumns({b: F.col(b) * 0.0001 for b in ("b03", "b04", "b08")})), "red", "green", "blue")


def long_bands(v) -> DataFrame:
    return v("pixels_v").unpivot(["item_id", "n", "cx", "cy", "source"], list(NAMES), "band", "v")


LONG = "(SELECT item_id, n, cx, cy, source, UNNEST(['b03', 'b04', 'b05', 'b08', 'b8a', 'b11']) AS band, UNNEST([b03, b04, b05, b08, b8a, b11]) AS v FROM pixels_v)"


@q("m14_stretch", f"""
WITH l AS (SELECT * FROM {LONG} x), p AS (SELECT band, quantile_cont(v, 0.02) AS lo, quantile_cont(v, 0.98) AS hi FROM l WHERE v > 0 GROUP BY 1),
b AS (SELECT band, CAST(least(greatest(round((v - lo) / (hi - lo) * 255), 0), 255) AS BIGINT) AS byte FROM l JOIN p USING (band))
SELECT band, CAST(sum(byte) AS BIGINT) AS total, count(*) AS n FROM b GROUP BY 1""")
def _(v):
    return composite.percentile_stretch(long_bands(v)).groupBy("band").agg(F.sum(F.col("byte").cast("long")).alias("total"), F.count(F.lit(1)).alias("n"))


MED = ", ".join(f"median({b}) AS {b}" for b in NAMES)


@q("a01_temporal_median", f"SELECT source, {MONTH}, cx, cy, {', '.join(f'median(b.{b}) AS {b}' for b in NAMES)}, count(*) AS looks FROM pixels_v b GROUP BY 1, 2, 3, 4")
def _(v):
    return composite.temporal_median(monthly(v("pixels_v")), ("source", "ym", "cx", "cy"))


@q("a02_scl_composite", f"""
WITH s AS (SELECT tile_id, cx, cy, {screened(L2A, '0.0001e0', ' - 0.1e0')} FROM pixels_v WHERE source = 'l2a' AND acquired >= TIMESTAMP '1998-06-01' AND acquired < TIMESTAMP '1998-07-01'),
d AS (SELECT tile_id, cx, cy, {MED} FROM s GROUP BY 1, 2, 3),
f AS (SELECT cx, cy, {', '.join(f'max_by({b}, tile_id) FILTER ({b} IS NOT NULL) AS {b}' for b in NAMES)} FROM d GROUP BY 1, 2)
SELECT cx, cy, {round_sql()}, {index_sql()} FROM f""")
def _(v):
    return rounded(composite.scl_composite(later(v).filter("source = 'l2a'"), 2015, 6))


def later(v) -> DataFrame:
    """The pixels 17 years later, when there were such satellites."""
    return v("pixels_v").withColumn("acquired", F.col("acquired") + F.make_ym_interval(F.lit(17)))


@q("a02_qai_composite", f"""
WITH s AS (SELECT cx, cy, {screened(QAI, '0.0001e0')} FROM pixels_v WHERE source = 'boa' AND acquired >= TIMESTAMP '1998-06-01' AND acquired < TIMESTAMP '1998-07-01'),
f AS (SELECT cx, cy, {MED}, count(*) AS looks FROM s GROUP BY 1, 2) SELECT cx, cy, {round_sql()}, looks, {index_sql()} FROM f""")
def _(v):
    return rounded(composite.qai_composite(later(v).filter("source = 'boa'"), 2015, 6))


@q("a02_orbit_composite", f"""
WITH s AS (SELECT cx, cy, {screened(V200, '0.0001e0', ' - 0.1e0', 0)} FROM pixels_v WHERE source = 'orbit' AND acquired >= TIMESTAMP '1998-06-01' AND acquired < TIMESTAMP '1998-07-01'),
f AS (SELECT cx, cy, {MED}, count(*) AS looks FROM s GROUP BY 1, 2) SELECT cx, cy, {round_sql()}, looks, {index_sql()} FROM f""")
def _(v):
    return rounded(composite.orbit_composite(later(v).filter("source = 'orbit'"), 2015, 6, m.V200))


@q("a03_orbit_product", f"WITH s AS (SELECT {KEY}, {screened(V100, '0.001e0', '', 9999)} FROM pixels_v WHERE source = 'orbit') SELECT {KEY}, {index_sql()} FROM s")
def _(v):
    return keyed(composite.orbit_product(v("pixels_v").filter("source = 'orbit'"), m.V100), *m.INDICES)


COMP = f"""WITH s AS (SELECT source, cx, cy, {screened(QAI, '0.0001e0')} FROM pixels_v), f AS (SELECT source, cx, cy, {MED} FROM s GROUP BY 1, 2, 3),
ix AS (SELECT source, cx, cy, {index_sql(False)} FROM f), lg AS (SELECT source, cx, cy, UNNEST(['ndvi', 'gndvi', 'ndre', 'ndwi']) AS "index", UNNEST([ndvi, gndvi, ndre, ndwi]) AS v FROM ix)"""


def values(v) -> DataFrame:
    return compare.long_indices(m.with_indices(composite.temporal_median(m.screen_qai(v("pixels_v")), ("source", "cx", "cy"))))


@q("a04_band_statistics", COMP + ' SELECT source, "index", count(v) AS valid, round(min(v), 6) AS minimum, round(max(v), 6) AS maximum, round(avg(v), 6) AS mean, round(stddev_pop(v), 6) AS stddev FROM lg GROUP BY 1, 2')
def _(v):
    return rounded(compare.band_statistics(values(v)))


@q("a05_histogram", COMP + """, b AS (SELECT source, "index", CAST(least(floor((v + 1) / 0.03125e0), 63) AS INT) AS bin, count(*) AS n FROM lg WHERE v IS NOT NULL AND v BETWEEN -1 AND 1 GROUP BY 1, 2, 3),
t AS (SELECT source, "index", sum(n) AS total FROM b GROUP BY 1, 2), d AS (SELECT source, "index", total, CAST(UNNEST(range(64)) AS INT) AS bin FROM t)
SELECT d.source, d."index", d.bin, coalesce(n, 0) AS n, round(coalesce(n, 0) / total / 0.03125e0, 6) AS density FROM d LEFT JOIN b ON b.source = d.source AND b."index" = d."index" AND b.bin = d.bin""")
def _(v):
    return rounded(compare.histogram(values(v)).select("source", "index", "bin", "n", "density"))


@q("a06_coverage", COMP + ' SELECT source, "index", round(least(100.0e0, count(v) * 100.0e0 / 200), 6) AS coverage_pct, round(100 - least(100.0e0, count(v) * 100.0e0 / 200), 6) AS masked_pct FROM lg GROUP BY 1, 2')
def _(v):
    return rounded(compare.coverage(values(v), 200).select("source", "index", "coverage_pct", "masked_pct"))


PAIRS = [("l2a", "boa"), ("l2a", "orbit")]
CONF = MASKS_SQL + """, fl AS (SELECT source, date, cx, cy, cloud OR shadow OR (source = 'boa' AND buffer) AS f FROM mk),
pr AS (SELECT a.source || '_' || b.source AS pair, a.date, a.f AS a, b.f AS b FROM fl a JOIN fl b ON a.date = b.date AND a.cx = b.cx AND a.cy = b.cy AND a.source = 'l2a' AND b.source <> 'l2a'),
cf AS (SELECT pair, date, count(*) FILTER (a AND b) AS "both", count(*) FILTER (a AND NOT b) AS first_only, count(*) FILTER (NOT a AND b) AS second_only, count(*) FILTER (NOT a AND NOT b) AS neither FROM pr GROUP BY 1, 2)"""
AGREE = """, ag AS (SELECT *, "both" + first_only + second_only + neither AS n, ("both" + neither) * 1.0e0 / ("both" + first_only + second_only + neither) AS ob,
("both" + first_only) * 1.0e0 / ("both" + first_only + second_only + neither) AS p1, ("both" + second_only) * 1.0e0 / ("both" + first_only + second_only + neither) AS p2 FROM {t}),
mt AS (SELECT *, 100 * ob AS agreement_pct, CASE WHEN "both" + first_only + second_only > 0 THEN "both" * 1.0e0 / ("both" + first_only + second_only) ELSE 1.0e0 END AS iou, p1 * p2 + (1 - p1) * (1 - p2) AS ex FROM ag),
kp AS (SELECT *, CASE WHEN ex < 1 THEN (ob - ex) / (1 - ex) ELSE 1.0e0 END AS kappa FROM mt)"""


def confusion(v) -> DataFrame:
    rows = mask_rows(v)
    return compare.confusion(compare.mask_pairs(rows, PAIRS, compare.flag_of(F.col("source"), "boa")))


@q("j09_same_date_pairs", CONF + " SELECT pair, CAST(date AS VARCHAR) AS date, count(*) AS n FROM pr GROUP BY 1, 2")
def _(v):
    pairs = compare.mask_pairs(mask_rows(v), PAIRS, compare.flag_of(F.col("source"), "boa"))
    return pairs.groupBy("pair", F.col("date").cast("string").alias("date")).agg(F.count(F.lit(1)).alias("n"))


@q("a07_confusion", CONF + ' SELECT pair, CAST(date AS VARCHAR) AS date, "both", first_only, second_only, neither FROM cf')
def _(v):
    return confusion(v).withColumn("date", F.col("date").cast("string"))


@q("a08_agreement", CONF + AGREE.format(t="cf") + " SELECT pair, CAST(date AS VARCHAR) AS date, round(agreement_pct, 6) AS agreement_pct, round(iou, 6) AS iou, round(kappa, 6) AS kappa FROM kp")
def _(v):
    return rounded(compare.agreement(confusion(v)).select("pair", F.col("date").cast("string").alias("date"), "agreement_pct", "iou", "kappa"))


POOL = ', po AS (SELECT pair, CAST(sum("both") AS BIGINT) AS "both", CAST(sum(first_only) AS BIGINT) AS first_only, CAST(sum(second_only) AS BIGINT) AS second_only, CAST(sum(neither) AS BIGINT) AS neither FROM cf GROUP BY 1)'


@q("a09_pooled_agreement", CONF + POOL + AGREE.format(t="po") + ' SELECT pair, "both", neither, round(agreement_pct, 6) AS agreement_pct, round(iou, 6) AS iou, round(kappa, 6) AS kappa, round("both" * 100.0e0 / n, 6) AS both_pct FROM kp')
def _(v):
    return rounded(compare.flagged_shares(compare.agreement(compare.pooled(confusion(v)))).select("pair", "both", "neither", "agreement_pct", "iou", "kappa", "both_pct"))


@q("a10_mean_agreement", CONF + AGREE.format(t="cf") + " SELECT pair, round(avg(agreement_pct), 6) AS agreement_pct, round(avg(iou), 6) AS iou, round(avg(kappa), 6) AS kappa, count(*) AS dates FROM kp GROUP BY 1")
def _(v):
    return rounded(compare.mean_agreement(compare.agreement(confusion(v))))


SOURCES = ["l2a", "boa", "orbit"]
XY = """, o AS (SELECT *, CASE source WHEN 'l2a' THEN 0 WHEN 'boa' THEN 1 ELSE 2 END AS k FROM lg WHERE v IS NOT NULL),
xy AS (SELECT b.source || '_minus_' || a.source AS pair, a."index", a.v AS x, b.v AS y FROM o a JOIN o b ON a.cx = b.cx AND a.cy = b.cy AND a."index" = b."index" AND a.k < b.k{land})"""
DIFF = """ SELECT pair, "index", round(count(*) * 100.0e0 / 200, 6) AS common_valid_pct, round(avg(y - x), 6) AS mean_difference, round(median(y - x), 6) AS median_difference, round(sqrt(avg((y - x) * (y - x))), 6) AS rmsd,
round(avg(abs(y - x)), 6) AS mean_absolute_difference, round(corr(x, y), 6) AS pearson_r, round(avg(CASE WHEN abs(y - x) > 0.1 THEN 1 ELSE 0 END) * 100, 6) AS above_0_1_pct FROM xy GROUP BY 1, 2"""


@q("j10_source_pairs", COMP + XY.format(land="") + ' SELECT pair, "index", count(*) AS n FROM xy GROUP BY 1, 2')
def _(v):
    return compare.index_pairs(values(v), SOURCES).groupBy("pair", "index").agg(F.count(F.lit(1)).alias("n"))


@q("a11_differences", COMP + XY.format(land="") + DIFF)
def _(v):
    return rounded(compare.difference_statistics(compare.index_pairs(values(v), SOURCES), 200))


@q("a12_land_only", COMP + XY.format(land=" SEMI JOIN (SELECT cx, cy FROM pixels_v WHERE source = 'orbit' AND terrain < 60) w ON w.cx = a.cx AND w.cy = a.cy") + DIFF)
def _(v):
    land = v("pixels_v").filter("source = 'orbit' and terrain < 60").select("cx", "cy")
    return rounded(compare.difference_statistics(compare.index_pairs(values(v), SOURCES, land), 200))


OBS = MASKS_SQL + """, g AS (SELECT DISTINCT p.cx % 4 AS cx, p.cy % 2 AS cy, s.source FROM pixels_v p CROSS JOIN (SELECT UNNEST(['l2a', 'boa', 'orbit']) AS source) s),
c AS (SELECT source, cx, cy, count(*) FILTER (NOT invalid) AS clear FROM mk GROUP BY 1, 2, 3), ob AS (SELECT g.source, g.cx, g.cy, coalesce(clear, 0) AS clear FROM g LEFT JOIN c ON c.source = g.source AND c.cx = g.cx AND c.cy = g.cy)"""


@q("a13_observation_counts", OBS + " SELECT source, cx, cy, clear FROM ob")
def _(v):
    rows = mask_rows(v)
    return compare.observation_counts(rows, rows.select("cx", "cy").distinct()).select("source", "cx", "cy", "clear")


@q("a13_observation_summary", OBS + " SELECT source, round(avg(clear), 6) AS mean_clear, round(avg(CASE WHEN clear = 0 THEN 1 ELSE 0 END) * 100, 6) AS none_pct, round(avg(CASE WHEN clear >= 3 THEN 1 ELSE 0 END) * 100, 6) AS three_or_more_pct FROM ob GROUP BY 1")
def _(v):
    rows = mask_rows(v)
    return rounded(compare.observation_summary(compare.observation_counts(rows, rows.select("cx", "cy").distinct())))


PCT = MASKS_SQL + ", pc AS (SELECT date, source, avg(CASE WHEN cloud THEN 1 ELSE 0 END) * 100 AS cloud_pct, avg(CASE WHEN cloud OR shadow THEN 1 ELSE 0 END) * 100 AS cloud_or_shadow_pct, avg(CASE WHEN invalid THEN 1 ELSE 0 END) * 100 AS invalid_pct FROM mk GROUP BY 1, 2)"


@q("a14_flag_percentages", PCT + " SELECT CAST(date AS VARCHAR) AS date, round(max(cloud_or_shadow_pct) FILTER (source = 'l2a'), 6) AS l2a, round(max(cloud_or_shadow_pct) FILTER (source = 'boa'), 6) AS boa, round(max(cloud_or_shadow_pct) FILTER (source = 'orbit'), 6) AS orbit FROM pc GROUP BY 1")
def _(v):
    wide = compare.wide_percentages(compare.flag_percentages(mask_rows(v)), SOURCES)
    return rounded(wide.withColumn("date", F.col("date").cast("string")))


@q("a15_common_dates", PCT + " SELECT source, count(*) AS dates, round(avg(cloud_pct), 6) AS cloud_pct, round(avg(invalid_pct), 6) AS invalid_pct FROM pc WHERE date IN (SELECT date FROM pc GROUP BY 1 HAVING count(*) = 3) GROUP BY 1")
def _(v):
    return rounded(compare.common_date_means(compare.flag_percentages(mask_rows(v)), 3).select("source", "dates", "cloud_pct", "invalid_pct"))


@q("a26_timings", """WITH t AS (SELECT l_orderkey AS product, sum(l_quantity) FILTER (l_linenumber <= 3) AS mosaic, max(l_tax) AS idx, sum(l_quantity) FILTER (l_linenumber <= 3) + max(l_tax) - l_orderkey % 2 AS total FROM lineitem GROUP BY 1)
SELECT product, round(mosaic, 6) AS mosaic_s, CASE WHEN mosaic IS NULL THEN 'no-mosaic-timing' WHEN total < 0 THEN 'not-finite-or-negative' WHEN total + 0.01 < mosaic + idx THEN 'total-shorter-than-parts' END AS problem FROM t""")
def _(v):
    stage = F.when(F.col("l_linenumber") == 1, "scene_masking").when(F.col("l_linenumber") == 2, "tile_compositing").when(F.col("l_linenumber") == 3, "country_mosaicking")
    t = v("lineitem").groupBy(F.col("l_orderkey").alias("product"), stage.alias("stage")).agg(F.sum("l_quantity").alias("s"), F.max("l_tax").alias("tax"))
    per = t.groupBy("product").agg(F.map_from_entries(F.collect_list(F.when(F.col("stage").isNotNull(), F.struct("stage", "s")))).alias("m"), F.sum(F.when(F.col("stage").isNotNull(), F.col("s"))).alias("sum"), F.max("tax").alias("index_calculation"))
    more = F.create_map(F.lit("index_calculation"), F.col("index_calculation"), F.lit("total"), F.coalesce("sum", F.lit(0.0)) + F.col("index_calculation") - F.col("product") % 2)
    return rounded(compare.normal_timings(per.select("product", F.map_concat("m", more).alias("timings"))).select("product", "mosaic_s", "problem"))


@q("a27_timing_report", "SELECT CAST(l_linenumber AS VARCHAR) AS stage, round(sum(l_quantity) FILTER (l_returnflag = 'A') / 60, 6) AS A, round(sum(l_quantity) FILTER (l_returnflag = 'N') / 60, 6) AS N, round(sum(l_quantity) FILTER (l_returnflag = 'R') / 60, 6) AS R FROM lineitem GROUP BY 1")
def _(v):
    stages = v("lineitem").select(F.col("l_linenumber").cast("string").alias("stage"), F.col("l_returnflag").alias("source"), F.col("l_quantity").alias("seconds"))
    return rounded(compare.timing_report(stages, ["A", "N", "R"]))


@q("j05_coregistration", f"SELECT item_id, cx, cy, {', '.join(f'round(avg({b}), 6) AS {b}' for b in NAMES)} FROM pixels_v GROUP BY 1, 2, 3")
def _(v):
    return rounded(grid.wide_bands(long_bands(v)))


@q("j06_cross_resolution", "WITH s AS (SELECT cx, cy, max(b05) AS v FROM pixels_v GROUP BY 1, 2), t AS (SELECT DISTINCT cx, cy FROM pixels_v) SELECT t.cx, t.cy, v FROM t JOIN s ON s.cx = t.cx // 2 AND s.cy = t.cy // 2")
def _(v):
    px = v("pixels_v")
    coarse = px.groupBy("cx", "cy").agg(F.max("b05").alias("v"))
    return grid.nearest(px.select("cx", "cy").distinct(), coarse, 10.0, 20.0).select("cx", "cy", "v")


@q("j12_cutline", "SELECT item_id, n, cx, cy FROM pixels_v WHERE abs((cx + 0.5) * 20 - 200) / 200 + abs((cy + 0.5) * 20 - 100) / 100 <= 1")
def _(v):
    px = v("pixels_v")
    spark = px.sparkSession
    corners = [(0.0, 100.0), (200.0, 200.0), (400.0, 100.0), (200.0, 0.0)]
    edges = [(*a, *b) for a, b in zip(corners, corners[1:] + corners[:1], strict=True)]
    roi = spark.createDataFrame([(edges,)], "edges array<struct<x1:double,y1:double,x2:double,y2:double>>")
    return grid.clip(px, roi, 20.0).select("item_id", "n", "cx", "cy")


@q("r01_snap", "SELECT item_id, n, CAST(floor(b03 / 20.0e0) AS BIGINT) AS cx, CAST(floor((b04 - 2000) / 20.0e0) AS BIGINT) AS cy FROM pixels_v")
def _(v):
    return grid.snap(v("pixels_v").select("item_id", "n", F.col("b03").alias("x"), (F.col("b04") - 2000).alias("y")), 20.0).select("item_id", "n", "cx", "cy")


@q("r02_nearest", "WITH s AS (SELECT cx, cy, max(scl) AS v FROM pixels_v GROUP BY 1, 2), t AS (SELECT DISTINCT cx // 2 AS cx, cy // 2 AS cy FROM pixels_v) SELECT t.cx, t.cy, v FROM t JOIN s ON s.cx = t.cx * 2 + 1 AND s.cy = t.cy * 2 + 1")
def _(v):
    px = v("pixels_v")
    fine = px.groupBy("cx", "cy").agg(F.max("scl").alias("v"))
    targets = px.select(F.floor(F.col("cx") / 2).alias("cx"), F.floor(F.col("cy") / 2).alias("cy")).distinct()
    return grid.nearest(targets, fine, 20.0, 10.0).select("cx", "cy", "v")


@q("r03_bilinear", """
WITH s AS (SELECT cx, cy, avg(b04) AS v FROM pixels_v GROUP BY 1, 2), t AS (SELECT DISTINCT cx * 2 + 1 AS cx, cy * 2 + 1 AS cy FROM pixels_v),
u AS (SELECT cx, cy, (cx + 0.5e0) / 2 - 0.5e0 AS x, (cy + 0.5e0) / 2 - 0.5e0 AS y FROM t),
w AS (SELECT u.cx, u.cy, (1 - abs(u.x - s.cx)) * (1 - abs(u.y - s.cy)) AS w, v FROM u JOIN s ON abs(u.x - s.cx) < 1 AND abs(u.y - s.cy) < 1)
SELECT cx, cy, round(sum(w * v) / sum(w), 6) AS v FROM w GROUP BY 1, 2""")
def _(v):
    px = v("pixels_v")
    cells = px.groupBy("cx", "cy").agg(F.avg("b04").alias("v"))
    targets = px.select((F.col("cx") * 2 + 1).alias("cx"), (F.col("cy") * 2 + 1).alias("cy")).distinct()
    return rounded(grid.bilinear(targets, cells, 10.0, 20.0))


@q("r04_block_statistics", """
WITH b AS (SELECT cx // 4 AS cx, cy // 4 AS cy, b04, scl FROM pixels_v), mo AS (SELECT cx, cy, scl, count(*) AS n FROM b GROUP BY 1, 2, 3), mm AS (SELECT cx, cy, arg_min(scl, scl) AS mode FROM mo x WHERE n = (SELECT max(n) FROM mo y WHERE y.cx = x.cx AND y.cy = x.cy) GROUP BY 1, 2)
SELECT cx, cy, round(avg(b04), 6) AS average, min(b04) AS least, max(b04) AS most, CAST(sum(b04) AS BIGINT) AS total, median(b04) AS med, quantile_cont(b04, 0.25) AS q1, quantile_cont(b04, 0.75) AS q3, round(sqrt(avg(b04 * b04)), 6) AS rms, any_value(mode) AS mode FROM b JOIN mm USING (cx, cy) GROUP BY 1, 2""")
def _(v):
    kinds = {"average": "average", "least": "min", "most": "max", "total": "sum", "med": "med", "q1": "q1", "q3": "q3", "rms": "rms"}
    stats = {n: (k, "b04") for n, k in kinds.items()} | {"mode": ("mode", "scl")}
    return rounded(grid.coarsen(v("pixels_v"), 4, stats))


@q("r05_source_order", "WITH r AS (SELECT cx, cy, b04 AS v, row_number() OVER (PARTITION BY cx, cy ORDER BY item_id DESC, n DESC, b04 DESC) AS rn FROM pixels_v WHERE (qai & 799) = 0) SELECT cx, cy, v FROM r WHERE rn = 1")
def _(v):
    cells = v("pixels_v").select("cx", "cy", F.struct("item_id", "n", "b04").alias("ord"), F.when(m.qai_clear(F.col("qai")), F.col("b04")).alias("v"))
    return grid.source_order_mosaic(cells)


@q("r06_union_extent", "SELECT cx, cy, count(*) AS n, max(b04) FILTER (source = 'l2a') AS b04, max(b08) FILTER (source = 'boa') AS b08, max(b11) FILTER (source = 'orbit') AS b11 FROM pixels_v GROUP BY 1, 2")
def _(v):
    px = v("pixels_v")
    every = grid.union_extent(*(px.filter(F.col("source") == s).select("cx", "cy", b) for s, b in (("l2a", "b04"), ("boa", "b08"), ("orbit", "b11"))))
    return every.groupBy("cx", "cy").agg(F.count(F.lit(1)).alias("n"), *(F.max(b).alias(b) for b in ("b04", "b08", "b11")))


@q("r07_stack", "WITH r AS (SELECT cx, cy, source, b04 AS v, row_number() OVER (PARTITION BY source, cx, cy ORDER BY item_id DESC, n DESC, b04 DESC) AS rn FROM pixels_v) SELECT cx, cy, max(v) FILTER (source = 'l2a') AS l2a, max(v) FILTER (source = 'boa') AS boa, max(v) FILTER (source = 'orbit') AS orbit FROM r WHERE rn = 1 GROUP BY 1, 2")
def _(v):
    pieces = v("pixels_v").select(F.col("source").alias("asset_key"), F.struct("item_id", "n", "b04").alias("ord"), "cx", "cy", F.col("b04").alias("v"))
    return grid.stack_features(pieces, ["l2a", "boa", "orbit"])


@q("r13_cube_tiles", "WITH t AS (SELECT CAST(floor((b03 * 100 - 0) / 30000.0e0) AS INT) AS tx, CAST(floor((500000 - b04 * 100) / 30000.0e0) AS INT) AS ty FROM pixels_v) SELECT printf('X%04d_Y%04d', tx, ty) AS tile, count(*) AS n FROM t GROUP BY 1")
def _(v):
    px = v("pixels_v").select((F.col("b03") * 100).alias("x"), (F.col("b04") * 100).alias("y"))
    return grid.cube_tiles(px, 0.0, 500_000.0).groupBy("tile").agg(F.count(F.lit(1)).alias("n"))


@q("o06_union_masks", "SELECT source, count(*) AS n FROM pixels_v GROUP BY 1")
def _(v):
    px = v("pixels_v")
    return grid.union_extent(*(px.filter(F.col("source") == s).select("source", "cx", "cy") for s in SOURCES)).groupBy("source").agg(F.count(F.lit(1)).alias("n"))


@q("t10_unfinished_tiles", "SELECT DISTINCT tile_id FROM pixels_v WHERE tile_id NOT IN (SELECT tile_id FROM pixels_v WHERE tile_id % 2 = 0)")
def _(v):
    px = v("pixels_v")
    return composite.unfinished_tiles(px, px.filter("tile_id % 2 = 0"))


@q("s06_block_scan", "SELECT item_id, cx, cy, round(CAST(CAST(avg(b04) AS FLOAT) AS DOUBLE), 3) AS b04 FROM pixels_v GROUP BY 1, 2, 3")
def _(v):
    blocks = composite.pixels_to_blocks(v("pixels_v"), width=4)
    cells = composite.blocks_to_pixels(blocks, 4).filter("b04 is not null")
    return cells.select("item_id", "cx", "cy", F.round(F.col("b04").cast("double"), 3).alias("b04"))


FLOAT_CELLS = "c AS (SELECT cx, cy, CAST(CAST(avg(b04) AS FLOAT) AS DOUBLE) AS v FROM pixels_v GROUP BY 1, 2)"


def cells_of(blocks: DataFrame, width: int, *keys: str) -> DataFrame:
    """Cells with a value of b04."""
    cells = composite.blocks_to_pixels(blocks, width, ("b04",)).filter("b04 is not null and not isnan(b04)")
    return cells.select(*keys, "cx", "cy", F.round(F.col("b04").cast("double"), 3).alias("b04"))


@q("r03_block_bilinear", f"""
WITH {FLOAT_CELLS}, t AS (SELECT DISTINCT cx // 4 * 8 + x AS cx, cy // 4 * 8 + y AS cy FROM c, range(8) a(x), range(8) b(y)),
u AS (SELECT cx, cy, (cx + 0.5e0) / 2 - 0.5e0 AS x, (cy + 0.5e0) / 2 - 0.5e0 AS y FROM t),
w AS (SELECT u.cx, u.cy, (1 - abs(u.x - c.cx)) * (1 - abs(u.y - c.cy)) AS w, v FROM u JOIN c ON abs(u.x - c.cx) < 1 AND abs(u.y - c.cy) < 1)
SELECT cx, cy, round(sum(w * v) / sum(w), 3) AS b04 FROM w GROUP BY 1, 2""")
def _(v):
    blocks = composite.pixels_to_blocks(v("pixels_v"), (), 4, ("b04",))
    return cells_of(tiled.resample_blocks(blocks, 4, 2, "b04"), 8)


@q("r02_block_nearest", f"WITH {FLOAT_CELLS} SELECT cx * 3 + x AS cx, cy * 3 + y AS cy, round(v, 3) AS b04 FROM c, range(3) a(x), range(3) b(y)")
def _(v):
    blocks = composite.pixels_to_blocks(v("pixels_v"), (), 4, ("b04",))
    return cells_of(tiled.resample_blocks(blocks, 4, 3, "b04", "nearest"), 12)


@q("j12_block_cutline", "SELECT item_id, cx, cy, round(CAST(CAST(avg(b04) AS FLOAT) AS DOUBLE), 3) AS b04 FROM pixels_v WHERE abs((cx + 0.5) * 20 - 200) / 200 + abs((cy + 0.5) * 20 - 100) / 100 <= 1 GROUP BY 1, 2, 3")
def _(v):
    px = v("pixels_v")
    corners = [(0.0, 100.0), (200.0, 200.0), (400.0, 100.0), (200.0, 0.0)]
    outline = px.sparkSession.createDataFrame([(*a, *b) for a, b in zip(corners, corners[1:] + corners[:1], strict=True)], "x1 double, y1 double, x2 double, y2 double")
    blocks = composite.pixels_to_blocks(px, width=2, bands=("b04",))
    return cells_of(tiled.clip_blocks(blocks, outline, 2, 20.0, ("b04",)), 2, "item_id")


@q("x04_block_median", f"WITH f AS (SELECT source, item_id, cx, cy, {', '.join(f'CAST(avg({b}) AS FLOAT) AS {b}' for b in NAMES)} FROM pixels_v GROUP BY 1, 2, 3, 4) SELECT source, cx, cy, {', '.join(f'round(CAST(median({b}) AS DOUBLE), 2) AS {b}' for b in NAMES)} FROM f GROUP BY 1, 2, 3")
def _(v):
    blocks = composite.pixels_to_blocks(v("pixels_v"), ("source", "item_id"), 4)
    code = blocks.withColumn("s", F.when(F.col("source") == "l2a", 0).when(F.col("source") == "boa", 1).otherwise(2).cast("long"))
    med = composite.block_median(code, ("s", "bx", "by"))
    cells = composite.blocks_to_pixels(med, 4).filter("b04 is not null")
    name = F.when(F.col("s") == 0, "l2a").when(F.col("s") == 1, "boa").otherwise("orbit")
    return cells.select(name.alias("source"), "cx", "cy", *(F.round(F.col(b).cast("double"), 2).alias(b) for b in NAMES))


@q("x02_own_index", "SELECT item_id, n, cx, cy, (b11 - b03) * 1.0e0 / (b11 + b03) AS own FROM pixels_v")
def _(v):
    return m.with_indices(v("pixels_v"), {"own": ("b11", "b03")}).select("item_id", "n", "cx", "cy", "own")


@q("x03_rule_rows", f"WITH s AS (SELECT {KEY}, {screened('cloudmask < 2 AND terrain < 30', '0.01e0', '', 300)} FROM pixels_v) SELECT {KEY}, {round_sql()} FROM s")
def _(v):
    rule = m.OrbitRule("own", 0.01, 0.0, 300, ("cloudmask < 2",), ("terrain < 30",))
    return keyed(m.screen_orbit(v("pixels_v"), rule), *NAMES)


@q("p14_pixel_window", "SELECT item_id, n, cx, cy FROM pixels_v WHERE cx BETWEEN 3 AND 9 AND cy BETWEEN 2 AND 6")
def _(v):
    from orbitgrain.functions.predicates import in_pixel_window, pixel_window

    window = pixel_window((1060.0, 1460.0, 1195.0, 1960.0), (20, 10), (1000.0, 20.0, 0.0, 2000.0, 0.0, -100.0))
    left, top, width, height = window
    return v("pixels_v").filter(in_pixel_window((left, top + 2, width, height - 1))).select("item_id", "n", "cx", "cy")
