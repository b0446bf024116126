"""Monthly composites."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orbitgrain.functions import masks
from orbitgrain.functions.predicates import in_month
from orbitgrain.operators.grid import clip
from orbitgrain.operators.quantiles import exact_quantiles

BANDS = masks.BANDS
#: A block's cells are reduced in so many slices at most, and so many bytes of looks are packed at a time.
SLICES, PACKED = 16, 64 << 20


def temporal_median(pixels: DataFrame, keys=("cx", "cy"), bands=BANDS) -> DataFrame:
    """Exact median of each band over the looks that have it; null if none has."""
    return pixels.groupBy(*keys).agg(*(F.median(b).alias(b) for b in bands), F.count(F.lit(1)).alias("looks"))


def block_median(blocks: DataFrame, keys=("bx", "by"), bands=BANDS) -> DataFrame:
    """A01, X04 for national grids: one row for each block and look, bands as arrays of float; nan or null is nodata.

    Tasks first pack the values that are there, in slices of cells; a slice's
    values of one band then meet in one task, four bytes each, and are reduced
    by one vectorised median. A look without an array for a band has no data in
    it; if no look has one, neither has the result. Looks of different lengths
    are an error.
    """
    kinds = {f.name: f.dataType.simpleString() for f in blocks.schema}
    head = ", ".join(f"{k} {kinds[k]}" for k in keys)

    def pack(table: pa.Table):
        """(keys, band, slice, size, counts by cell, values by cell): a row for each slice of a block's band; size is null where no look has an array."""
        groups = table.select(keys).append_column("_i", pa.array(np.arange(len(table)))).group_by(list(keys), use_threads=False).aggregate([("_i", "list")])
        order = groups.column("_i_list").combine_chunks()
        of_row = np.repeat(np.arange(len(groups)), order.value_lengths().to_numpy(zero_copy_only=False))
        table = table.take(order.flatten())
        for n, b in enumerate(bands):
            column = table.column(b).combine_chunks()
            there = column.is_valid().to_numpy(zero_copy_only=False)
            arrays, group = column.drop_null(), of_row[there]
            sizes = arrays.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            size = np.full(len(groups), -1)
            size[group] = sizes
            if (size[group] != sizes).any():
                raise ValueError(f"looks of a block have {b} in different lengths")
            flat = arrays.flatten().to_numpy(zero_copy_only=False).astype(np.float32, copy=False)
            known = np.flatnonzero(~np.isnan(flat))
            starts = np.cumsum(sizes) - sizes
            look = np.searchsorted(starts + sizes, known, side="right")
            ahead = np.r_[0, np.cumsum(np.maximum(size, 0))]  # every cell of every block has a number
            cell = ahead[group[look]] + known - starts[look]
            values = flat[known][np.argsort(cell, kind="stable")]
            counts = np.bincount(cell, minlength=ahead[-1]).astype(np.int32)
            through = np.r_[0, np.cumsum(counts)]
            rows = []
            for g in range(len(groups)):
                wide = max(1, -(-size[g] // SLICES))
                for s in range(max(1, -(-size[g] // wide))):
                    lo, hi = ahead[g] + s * wide, ahead[g] + min(max(size[g], 0), (s + 1) * wide)
                    rows.append((g, s, None if size[g] < 0 else int(size[g]), counts[lo:hi].tobytes(), values[through[lo] : through[hi]].tobytes()))
            g, s, z, c, v = zip(*rows, strict=True)
            own = groups.select(keys).take(pa.array(g)).combine_chunks()
            yield from pa.table([*own.columns, pa.array([n] * len(g), pa.int32()), pa.array(s, pa.int32()), pa.array(z, pa.int32()), pa.array(c, pa.binary()), pa.array(v, pa.binary())], [*keys, "band", "slice", "size", "counts", "values"]).to_batches()

    def packed(batches):
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch.nbytes
            if size > PACKED:
                yield from pack(pa.Table.from_batches(held))
                held, size = [], 0
        if size:
            yield from pack(pa.Table.from_batches(held))

    def middle(key: tuple, table: pa.Table) -> pa.Table:
        table = table.filter(pc.is_valid(table.column("size")))
        sizes = set(table.column("size").to_pylist())
        if len(sizes) > 1:
            raise ValueError(f"looks of a block have {bands[key[-2].as_py()]} in different lengths")
        cells = pa.array([None], pa.list_(pa.float32()))
        if sizes:
            counts = [np.frombuffer(c, np.int32) for c in table.column("counts").to_pylist()]
            values = np.concatenate([np.frombuffer(x, np.float32) for x in table.column("values").to_pylist()])
            cell = np.concatenate([np.repeat(np.arange(len(c)), c) for c in counts])
            n = np.sum(counts, 0, dtype=np.int64)
            values = values[np.lexsort((values, cell))]
            some, start = np.flatnonzero(n), (np.cumsum(n) - n)
            out = np.full(len(n), np.nan, np.float32)
            low, high = values[(start + (n - 1) // 2)[some]], values[(start + n // 2)[some]]
            with np.errstate(invalid="ignore", over="ignore"):
                out[some] = np.where(low == high, low, (low + high) / np.float32(2))
            cells = pa.ListArray.from_arrays(pa.array([0, len(out)], pa.int32()), pa.array(out, from_pandas=True))
        return pa.table([*(pa.array([k.as_py()], k.type) for k in key), cells], [*keys, "band", "slice", "cells"])

    parts = blocks.select(*keys, *(F.col(b).cast("array<float>").alias(b) for b in bands)).mapInArrow(packed, f"{head}, band int, slice int, size int, counts binary, values binary")
    reduced = parts.groupBy(*keys, "band", "slice").applyInArrow(middle, f"{head}, band int, slice int, cells array<float>")
    joined = (F.array_sort(F.collect_list(F.when((F.col("band") == n) & F.col("cells").isNotNull(), F.struct("slice", "cells")))).alias(b) for n, b in enumerate(bands))
    return reduced.groupBy(*keys).agg(*joined).select(*keys, *(F.when(F.size(b) > 0, F.flatten(F.col(b)["cells"])).alias(b) for b in bands))


def blocks_to_pixels(blocks: DataFrame, width: int = 512, bands=BANDS) -> DataFrame:
    """One row a cell; filter blocks before, so that only wanted ones are opened."""
    keep = [c for c in blocks.columns if c not in bands and c not in ("bx", "by")]
    opened = blocks.select(*keep, "bx", "by", F.posexplode(F.arrays_zip(*bands)).alias("i", "v"))
    cell = {"cx": (F.col("bx") * width + F.col("i") % width).cast("long"), "cy": (F.col("by") * width + F.expr(f"i div {width}")).cast("long")}
    return opened.withColumns(cell).select(*keep, "cx", "cy", "v.*")


def pixels_to_blocks(pixels: DataFrame, keys=("item_id",), width: int = 16, bands=BANDS) -> DataFrame:
    """Inverse of :func:`blocks_to_pixels`; cells without a row are null.

    Only cells with a row are grouped and shuffled; nulls are put between them
    once a block's cells are together.
    """
    at = {"bx": F.floor(F.col("cx") / width).cast("int"), "by": F.floor(F.col("cy") / width).cast("int"), "i": (F.pmod(F.col("cy"), F.lit(width)) * width + F.pmod(F.col("cx"), F.lit(width))).cast("int")}
    rows = pixels.withColumns(at).select(*keys, "bx", "by", "i", *bands)
    cells = rows.groupBy(*keys, "bx", "by", "i").agg(*(F.avg(b).cast("float").alias(b) for b in bands))
    some = cells.groupBy(*keys, "bx", "by").agg(F.array_sort(F.collect_list(F.struct("i", *bands))).alias("cells"))
    place = lambda k: F.coalesce(F.get(F.col("cells"), k)["i"], F.when(k < 0, F.lit(-1)).otherwise(F.lit(width * width)))
    gap = lambda k: F.array_repeat(F.lit(None).cast(some.schema["cells"].dataType.elementType), place(k) - place(k - 1) - 1)
    whole = F.concat(F.flatten(F.transform("cells", lambda c, k: F.concat(gap(k), F.array(c)))), gap(F.size("cells")))
    blocks = some.withColumn("cells", whole)
    return blocks.select(*keys, "bx", "by", *(F.col("cells").getField(b).alias(b) for b in bands))


def scl_composite(pixels: DataFrame, year: int, month: int, roi: DataFrame | None = None, resolution: float = 20.0, tiles: DataFrame | None = None) -> DataFrame:
    """A02, catalogue route: joint screening, median by tile, then the later tile wins where tiles overlap.

    ``tiles`` (tile_id) restricts the work, see :func:`unfinished_tiles`.
    """
    month_rows = pixels.filter(in_month("acquired", year, month))
    if tiles is not None:
        month_rows = month_rows.join(F.broadcast(tiles), "tile_id", "left_semi")
    medians = temporal_median(masks.screen_scl_cld(month_rows), ("tile_id", "cx", "cy"))
    # tiles lie over each other in order of name; per band the last with a value wins
    merged = medians.groupBy("cx", "cy").agg(*(F.max_by(b, F.when(F.col(b).isNotNull(), F.col("tile_id"))).alias(b) for b in BANDS))
    return _finished(merged, roi, resolution)


def qai_composite(pixels: DataFrame, year: int, month: int, roi: DataFrame | None = None, resolution: float = 10.0) -> DataFrame:
    """A02, BOA and QAI route: one median over all looks."""
    return _finished(temporal_median(masks.screen_qai(pixels.filter(in_month("acquired", year, month)))), roi, resolution)


def orbit_composite(pixels: DataFrame, year: int, month: int, rule: masks.OrbitRule, roi: DataFrame | None = None, resolution: float = 10.0) -> DataFrame:
    """A02, orbit-mosaic route."""
    return _finished(temporal_median(masks.screen_orbit(pixels.filter(in_month("acquired", year, month)), rule)), roi, resolution)


def orbit_product(pixels: DataFrame, rule: masks.OrbitRule, use_cloud: bool = True, use_terrain: bool = True) -> DataFrame:
    """Reflectance and indices of each published mosaic, without a median."""
    return masks.with_indices(masks.screen_orbit(pixels, rule, use_cloud, use_terrain))


def _finished(cells: DataFrame, roi: DataFrame | None, resolution: float) -> DataFrame:
    return masks.with_indices(cells if roi is None else clip(cells, roi, resolution))


def percentile_stretch(values: DataFrame, low: float = 0.02, high: float = 0.98) -> DataFrame:
    """(band, v) scaled between percentiles of the band's positive values, else between its extremes; one row of ends a band is sent to all."""
    ends = values.groupBy("band").agg(F.min("v").alias("least"), F.max("v").alias("most"))
    inner = exact_quantiles(values.filter("v > 0"), ["band"], "v", [low, high])
    ends = ends.join(inner, "band", "left").select("band", F.coalesce(F.get("q", 0), "least").alias("lo"), F.coalesce(F.get("q", 1), "most").alias("hi"))
    return values.join(F.broadcast(ends), "band").withColumn("byte", masks.scaled_byte(F.col("v"), F.col("lo"), F.col("hi")))


def unfinished_tiles(pixels: DataFrame, finished: DataFrame) -> DataFrame:
    """Tiles whose median is not yet written."""
    return pixels.select("tile_id").distinct().join(finished.select("tile_id").distinct(), "tile_id", "left_anti")


def minimum_slice(pixels: DataFrame, keys=("cx", "cy")) -> DataFrame:
    """QAI-screened median of two bands and NDVI by cell."""
    clear = masks.qai_clear(F.col("qai"))
    med = pixels.groupBy(*keys).agg(*(F.median(F.when(clear, F.col(b) * 0.0001)).alias(b) for b in ("b04", "b08")))
    return med.withColumn("ndvi", masks.normalized_difference(F.col("b08"), F.col("b04")))
