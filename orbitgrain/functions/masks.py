"""Pixel screening, indices and colours (M01-M14). nodata is null in our tables."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BANDS = ("b03", "b04", "b05", "b08", "b8a", "b11")
INDICES = {"ndvi": ("b08", "b04"), "gndvi": ("b08", "b03"), "ndre": ("b8a", "b05"), "ndwi": ("b08", "b11")}

# Fixed values of the quality layers.
SCL_INVALID = (0, 1, 3, 8, 9, 10, 11)
SCL_CLOUD, SCL_SHADOW, SCL_SNOW = (8, 9, 10), (3,), (11,)
CLD_MOST = 30
QAI_MASK = 0x031F
QAI_FIELDS = {"nodata": (0, 1), "cloud_state": (1, 3), "shadow": (3, 1), "snow": (4, 1), "subzero": (8, 1), "saturated": (9, 1)}


def physical(band: str, scale: float, offset: float) -> Column:
    """M01"""
    check_scale(scale, offset)
    return F.col(band).cast("double") * scale + offset


def check_scale(scale, offset) -> None:
    """Both known and finite, the scale positive."""
    import math

    if scale is None or offset is None or not (math.isfinite(scale) and math.isfinite(offset)) or scale <= 0:
        raise ValueError(f"scale {scale} and offset {offset} do not give reflectance")


def bad_scales(bands: DataFrame) -> DataFrame:
    """Rows of band metadata (scale, offset) that cannot be used."""
    finite = lambda c: F.col(c).isNotNull() & ~F.isnan(c) & (F.abs(F.col(c)) < float("inf"))
    return bands.filter(~(finite("scale") & finite("offset") & (F.col("scale") > 0)))


def scl_cld_valid(values: list[Column], scl: Column, cld: Column) -> Column:
    """Joint over all six bands; an unknown class passes, an unknown probability fails."""
    bands = reduce(and_, (v.isNotNull() & (v >= 0) for v in values))
    return F.coalesce(bands & (scl.isNull() | ~scl.isin(*SCL_INVALID)) & cld.between(0, CLD_MOST), F.lit(False))


def screen_scl_cld(pixels: DataFrame, scale: float = 0.0001, offset: float = -0.1) -> DataFrame:
    """Six bands as reflectance, all null where the pixel is invalid."""
    values = [physical(b, scale, offset) for b in BANDS]
    valid = scl_cld_valid(values, F.col("scl"), F.col("cld"))
    return pixels.withColumns({b: F.when(valid, v) for b, v in zip(BANDS, values, strict=True)})


def qai_clear(qai: Column, mask: int = QAI_MASK) -> Column:
    """M03; a signed 16-bit layer is read as unsigned."""
    return qai.cast("int").bitwiseAND(F.lit(0xFFFF & mask)) == 0


def screen_qai(pixels: DataFrame, scale: float = 0.0001, mask: int = QAI_MASK) -> DataFrame:
    """Per band."""
    return pixels.withColumns({b: F.when(qai_clear(F.col("qai"), mask), physical(b, scale, 0.0)) for b in BANDS})


@dataclass(frozen=True)
class OrbitRule:
    """A product's screening as data. ``cloud`` and ``terrain`` are SQL conditions that a valid pixel meets."""

    name: str
    scale: float
    offset: float
    nodata: int
    cloud: tuple[str, ...]
    terrain: tuple[str, ...]
    known: tuple[str, ...] = ()


V100 = OrbitRule("v100", 0.001, 0.0, 9999, ("cloudmask != 1",), ("terrain != 100",), ("terrain != 255", "cloudmask != 255"))
V200 = OrbitRule("v200", 0.0001, -0.1, 0, ("cloudmask = 0",), ("terrain < 90",))


def orbit_valid(rule: OrbitRule, use_cloud: bool = True, use_terrain: bool = True) -> Column:
    """M04-M06"""
    terms = [*rule.known, *(rule.cloud if use_cloud else ()), *(rule.terrain if use_terrain else ())]
    return reduce(and_, (F.coalesce(F.expr(t), F.lit(False)) for t in terms), F.lit(True))


def screen_orbit(pixels: DataFrame, rule: OrbitRule, use_cloud: bool = True, use_terrain: bool = True) -> DataFrame:
    """Per band."""
    valid = orbit_valid(rule, use_cloud, use_terrain)
    return pixels.withColumns({b: F.when(valid & (F.col(b) != rule.nodata), physical(b, rule.scale, rule.offset)) for b in BANDS})


def qai_fields(qai: Column) -> dict[str, Column]:
    """M07"""
    return {name: F.shiftright(qai.cast("int"), shift).bitwiseAND(F.lit(mask)) for name, (shift, mask) in QAI_FIELDS.items()}


def mask_layers(kind: str) -> dict[str, Column]:
    """Cloud, shadow, snow, buffer, other, route_invalid and route_invalid_without_buffer of one source."""
    no = F.lit(False)
    if kind == "scl":
        scl, cloudy = F.col("scl"), F.coalesce(F.col("cld") > CLD_MOST, no)
        invalid = scl.isin(*SCL_INVALID) | cloudy
        out = (scl.isin(*SCL_CLOUD) | cloudy, scl.isin(*SCL_SHADOW), scl.isin(*SCL_SNOW), no, scl.isin(0, 1), invalid, invalid)
    elif kind == "qai":
        qai = F.col("qai").cast("int")
        state = F.shiftright(qai, 1).bitwiseAND(F.lit(3))
        bit = lambda mask: qai.bitwiseAND(F.lit(mask)) != 0
        cloud = state.isin(2, 3)
        out = (cloud, bit(8), bit(16), state == 1, bit(0x0301), bit(QAI_MASK), bit(QAI_MASK & ~6) | cloud)
    elif kind == "v200":
        cm, facing = F.col("cloudmask"), F.col("terrain") >= 90
        out = (cm.isin(1, 2), cm == 3, no, no, facing, (cm != 0) | facing, (cm != 0) | facing)
    elif kind == "v100":
        cm, t = F.col("cloudmask"), F.col("terrain")
        gone = t.isin(100, 255) | (cm == 255)
        out = (cm == 1, no, no, no, gone, (cm == 1) | gone, (cm == 1) | gone)
    else:
        raise ValueError(f"no such mask source: {kind}")
    names = ("cloud", "shadow", "snow", "buffer", "other", "route_invalid", "route_invalid_without_buffer")
    return {n: F.coalesce(c, no) for n, c in zip(names, out, strict=True)}


def normalized_difference(p: Column, n: Column, least: float = 1e-12) -> Column:
    """Null where a band is missing or the sum is next to zero."""
    return F.when(F.abs(p + n) > least, (p - n) / (p + n))


def with_indices(df: DataFrame, definitions: dict[str, tuple[str, str]] = INDICES) -> DataFrame:
    """Indices by name from pairs of band names."""
    return df.withColumns({name: normalized_difference(F.col(p), F.col(n)) for name, (p, n) in definitions.items()})


def three_way_ndvi(pixels: DataFrame, scale: float = 0.0001, offset: float = -0.1) -> DataFrame:
    """Raw, SCL and CLD masked, QAI masked, from the same two bands."""
    values = [physical(b, scale, offset) for b in BANDS]
    raw = normalized_difference(values[3], values[1], 0.0)
    scl = F.coalesce(~F.col("scl").isin(*SCL_INVALID), F.lit(True)) & F.coalesce(F.col("cld").between(0, CLD_MOST), F.lit(False))
    return pixels.withColumns({"ndvi_raw": raw, "ndvi_scl": F.when(scl, raw), "ndvi_qai": F.when(qai_clear(F.col("qai")), raw)})


def recovered_probability(cld: Column, zero_is_valid: Column) -> Column:
    """M10"""
    return F.when(zero_is_valid & cld.isNull(), 0).otherwise(cld)


# NDVI stops, their colours and the classes that begin at them.
NDVI_STOPS = (
    (-1.0, (49, 54, 149), "water / very low"),
    (-0.2, (69, 117, 180), "water / shadow"),
    (0.0, (190, 77, 47), "bare / built"),
    (0.1, (230, 145, 56), "very sparse vegetation"),
    (0.2, (245, 216, 120), "sparse vegetation"),
    (0.35, (166, 217, 106), "moderate vegetation"),
    (0.5, (72, 161, 78), "dense vegetation"),
    (0.7, (0, 104, 55), "very dense vegetation"),
    (1.0, (0, 68, 27), "upper bound"),
)


def palette_class(v: Column) -> Column:
    """Name of the last stop at or below the value."""
    out = F.when(v.isNotNull(), F.lit(NDVI_STOPS[0][2]))
    for stop, _, name in NDVI_STOPS[1:]:
        out = F.when(v >= stop, F.lit(name)).otherwise(out)
    return out


def palette_colour(v: Column, channel: int) -> Column:
    """Linear between stops, clamped outside."""
    out = F.lit(float(NDVI_STOPS[0][1][channel]))
    for (a, low, _), (b, high, _) in zip(NDVI_STOPS[:-1], NDVI_STOPS[1:], strict=True):
        out = F.when(v >= a, low[channel] + (F.least(v, F.lit(b)) - a) / (b - a) * (high[channel] - low[channel])).otherwise(out)
    return F.when(v.isNotNull(), F.round(out).cast("int"))


def scaled_byte(v: Column, low: Column | float, high: Column | float) -> Column:
    """0 to 255 over a range; 0 where the range is empty."""
    low, high = (x if isinstance(x, Column) else F.lit(float(x)) for x in (low, high))
    share = F.when(high > low, (v - low) / (high - low)).otherwise(0.0)
    return F.when(v.isNotNull(), F.least(F.greatest(F.round(share * 255), F.lit(0.0)), F.lit(255.0)).cast("int"))


FALSE_COLOUR = (("b08", 0.8), ("b04", 0.5), ("b03", 0.5))  # fixed values


def false_colour(df: DataFrame) -> DataFrame:
    """M13"""
    return df.withColumns({c: scaled_byte(F.col(b), 0.0, high) for c, (b, high) in zip(("red", "green", "blue"), FALSE_COLOUR, strict=True)})
