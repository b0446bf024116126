"""Work on array blocks as they lie: window reads in Morton order, resampling with edges of neighbours, outlines row by row.

A block is a row (bx, by, band as an array of width * width values, row by
row); nan or null is nodata. Blocks that are not there are all nodata.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Morton order ---------------------------------------------------------------

#: Block numbers may go from -2^20 to 2^20 - 1 on either axis.
AXIS_BITS = 21
OFFSET = 1 << (AXIS_BITS - 1)


def _spread(v: Column) -> Column:
    """The bits of a number with a zero between any two."""
    for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)):
        v = v.bitwiseOR(F.shiftleft(v, shift)).bitwiseAND(F.lit(mask))
    return v


def morton(bx: Column, by: Column) -> Column:
    """Place of a block on the Morton curve; null outside the numbers it is made for."""
    x, y = bx.cast("long") + OFFSET, by.cast("long") + OFFSET
    inside = x.between(0, 2 * OFFSET - 1) & y.between(0, 2 * OFFSET - 1)
    return F.when(inside, _spread(x).bitwiseOR(F.shiftleft(_spread(y), 1)))


def morton_ranges(x0: int, y0: int, x1: int, y1: int, most: int = 32) -> list[tuple[int, int]]:
    """At most ``most`` ranges of the curve that hold all blocks of a window (ends included), and few others.

    Squares of the curve that the window meets in part are halved twice, largest
    first, while there is room; ranges that touch are joined.
    """
    a0, b0, a1, b1 = x0 + OFFSET, y0 + OFFSET, x1 + OFFSET, y1 + OFFSET
    if a0 > a1 or b0 > b1:
        return []
    whole: list[tuple[int, int]] = []
    partly = [(AXIS_BITS, 0, 0, 0)]  # level, corner, place on the curve
    while partly and len(whole) + len(partly) + 3 <= 4 * most:
        partly.sort()
        level, x, y, z = partly.pop()
        half = 1 << (level - 1)
        for k in range(4):
            cx, cy, cz = x + half * (k & 1), y + half * (k >> 1), z + k * half * half
            if cx > a1 or cy > b1 or cx + half <= a0 or cy + half <= b0:
                continue
            if a0 <= cx and cx + half - 1 <= a1 and b0 <= cy and cy + half - 1 <= b1:
                whole.append((cz, cz + half * half - 1))
            else:
                partly.append((level - 1, cx, cy, cz))
    ranges = sorted([*whole, *((z, z + (1 << 2 * level) - 1) for level, _, _, z in partly)])
    joined = ranges[:1]
    for a, b in ranges[1:]:
        joined[-1:] = [(joined[-1][0], b)] if a == joined[-1][1] + 1 else [joined[-1], (a, b)]
    while len(joined) > most:  # close the narrowest gap
        i = min(range(len(joined) - 1), key=lambda i: joined[i + 1][0] - joined[i][1])
        joined[i : i + 2] = [(joined[i][0], joined[i + 1][1])]
    return joined


def write_blocks(blocks: DataFrame, path: str, row_group_bytes: int = 8 << 20) -> None:
    """Blocks in Morton order, so that what lies close together is in few row groups, whose statistics tell their place.

    Blocks outside the curve's numbers are kept, with a null place. Many blocks
    of one place (looks) are dealt to several tasks.
    """
    placed = blocks.withColumn("morton", morton(F.col("bx"), F.col("by")))
    names = [c for c, kind in blocks.dtypes if not kind.startswith("array")]
    placed.repartitionByRange("morton", F.xxhash64(*names)).sortWithinPartitions("morton").write.mode("overwrite").option("parquet.block.size", row_group_bytes).parquet(path)


def read_window(spark: SparkSession, path: str, x0: int, y0: int, x1: int, y1: int, most: int = 32) -> DataFrame:
    """Blocks x0..x1, y0..y1 of a table written by :func:`write_blocks`: ranges of the curve reach the scan, which skips row groups, and the window itself is filtered after."""
    table = spark.read.parquet(path)
    near = F.lit(False)
    for a, b in morton_ranges(max(x0, -OFFSET), max(y0, -OFFSET), min(x1, OFFSET - 1), min(y1, OFFSET - 1), most):
        near = near | F.col("morton").between(a, b)
    if min(x0, y0) < -OFFSET or max(x1, y1) >= OFFSET:
        near = near | F.col("morton").isNull()
    return table.filter(near).filter(F.col("bx").between(x0, x1) & F.col("by").between(y0, y1)).drop("morton")


# Resampling -------------------------------------------------------------------


def _edges(blocks: DataFrame, keys: list[str], value: str, width: int) -> DataFrame:
    """What each block gives its eight neighbours: two rows, two columns and four corners, as (keys, bx, by of the neighbour, side, cells).

    ``side`` is where the giver lies, seen from the one who gets: dx + 3 * dy + 4.
    """
    row = lambda y: F.slice(value, y * width + 1, width)
    column = lambda x: F.transform(F.sequence(F.lit(0), F.lit(width - 1)), lambda y: F.get(value, y * width + x))
    one = lambda i: F.slice(value, i + 1, 1)
    n = width
    give = {(0, -1): row(n - 1), (0, 1): row(0), (-1, 0): column(n - 1), (1, 0): column(0), (-1, -1): one(n * n - 1), (1, -1): one(n * n - n), (-1, 1): one(n - 1), (1, 1): one(0)}
    sent = F.array(*(F.struct((F.col("bx") - dx).alias("bx"), (F.col("by") - dy).alias("by"), F.lit(dx + 3 * dy + 4).alias("side"), cells.alias("cells")) for (dx, dy), cells in give.items()))
    return blocks.filter(F.col(value).isNotNull()).select(*keys, F.explode(sent).alias("e")).select(*keys, "e.*")


def with_halo(blocks: DataFrame, width: int, value: str, keys: tuple[str, ...] = ()) -> DataFrame:
    """(keys, bx, by, value, halo): each block with what its neighbours lie against, ``halo`` a map from side to cells.

    A block moves once, with its own cells; its neighbours get nothing but
    edges, so what is shuffled beside the blocks grows with their outline.
    Only blocks that are there come out.
    """
    keys_ = list(keys)
    own = blocks.select(*keys_, "bx", "by", F.lit(4).alias("side"), F.col(value).alias("cells"))
    parts = own.unionByName(_edges(blocks, keys_, value, width).select(own.columns))
    met = parts.groupBy(*keys_, "bx", "by").agg(F.map_from_entries(F.collect_list(F.when(F.col("cells").isNotNull(), F.struct("side", "cells")))).alias("halo"))
    return met.filter(F.map_contains_key("halo", 4)).select(*keys_, "bx", "by", F.map_filter("halo", lambda k, _: k != 4).alias("halo"), F.element_at("halo", F.lit(4)).alias(value))


def resample_blocks(blocks: DataFrame, width: int, factor: int, value: str, method: str = "bilinear", keys: tuple[str, ...] = ()) -> DataFrame:
    """Every block on a grid ``factor`` times as fine, as blocks of ``width * factor`` with the same numbers.

    ``bilinear`` is the weighted mean of those of the four cells around a
    centre that have a value, ``nearest`` the cell under it, which needs no
    neighbours. Finer cells of blocks that are not there do not come out. One
    block is worked on at a time.
    """
    if method not in ("bilinear", "nearest") or factor < 1:
        raise ValueError(f"no such resampling: {method} by {factor}")
    kinds = {f.name: f.dataType.simpleString() for f in blocks.schema}
    ready = with_halo(blocks, width, value, keys) if method == "bilinear" else blocks.select(*keys, "bx", "by", value, F.expr("cast(map() as map<int,array<double>>)").alias("halo")).filter(F.col(value).isNotNull())
    at = (np.arange(width * factor) + 0.5) / factor - 0.5
    low, part = np.floor(at).astype(int), at - np.floor(at)

    def kernel(cells: np.ndarray, halo: dict) -> np.ndarray:
        n = width
        if method == "nearest":
            return cells.repeat(factor, 0).repeat(factor, 1)
        wide = np.full((n + 2, n + 2), np.nan)
        wide[1:-1, 1:-1] = cells
        place = {1: (0, slice(1, -1)), 7: (-1, slice(1, -1)), 3: (slice(1, -1), 0), 5: (slice(1, -1), -1), 0: (0, 0), 2: (0, -1), 6: (-1, 0), 8: (-1, -1)}
        for side, edge in halo.items():
            wide[place[side]] = edge if side % 2 else edge[0]
        known = ~np.isnan(wide)
        filled = np.where(known, wide, 0.0)

        def spread(grid: np.ndarray) -> np.ndarray:
            rows = grid[low + 1] * (1 - part)[:, None] + grid[low + 2] * part[:, None]
            return rows[:, low + 1] * (1 - part) + rows[:, low + 2] * part

        weight = spread(known.astype(float))
        with np.errstate(invalid="ignore", divide="ignore"):
            return np.where(weight > 0, spread(filled) / weight, np.nan)

    def run(batches):
        for batch in batches:
            out = []
            for cells, halo in zip(batch.column(value), batch.column("halo").to_pylist(), strict=True):
                grid = np.array(cells.values.to_numpy(zero_copy_only=False), float).reshape(width, width)
                edges = {side: np.array([np.nan if v is None else v for v in edge], float) for side, edge in halo or ()}
                out.append(pa.array(kernel(grid, edges).ravel(), from_pandas=True))
            flat = pa.concat_arrays(out) if out else pa.array([], pa.float64())
            fine = pa.ListArray.from_arrays(pa.array(np.arange(len(out) + 1) * (width * factor) ** 2, pa.int32()), flat)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in (*keys, "bx", "by")), fine], [*keys, "bx", "by", value])

    head = ", ".join(f"{k} {kinds[k]}" for k in (*keys, "bx", "by"))
    doubles = ready.withColumn(value, F.transform(value, lambda v: v.cast("double"))).withColumn("halo", F.transform_values("halo", lambda _, c: F.transform(c, lambda v: v.cast("double"))))
    return doubles.select(*keys, "bx", "by", value, "halo").mapInArrow(run, f"{head}, {value} array<double>")


# Outlines ---------------------------------------------------------------------


def outline_blocks(edges: DataFrame, width: int, resolution: float) -> DataFrame:
    """(bx, by, edges) for blocks that the outline (x1, y1, x2, y2) passes through, and (bx, by, null) for those wholly inside.

    Edges go to the rows of blocks they reach; a row of blocks knows which of
    its blocks edges touch, and of the stretches in between, a point tells
    whether they lie inside (scan lines). Runs of inner blocks are few a row
    and are then named one by one.
    """
    from orbitgrain.operators.grid import inside_polygon

    size = width * resolution
    number = lambda c: F.floor(c / size).cast("long")
    e = F.struct("x1", "y1", "x2", "y2")
    rows = edges.select(F.explode(F.sequence(number(F.least("y1", "y2")), number(F.greatest("y1", "y2")))).alias("by"), e.alias("e"))
    # the part of an edge within a row of blocks, and the blocks it passes there, one more at either side for rounding
    y0, y1 = F.col("by") * size, (F.col("by") + 1) * size
    level = F.col("e.y1") == F.col("e.y2")
    x_at = lambda y: F.when(level, F.col("e.x1")).otherwise(F.col("e.x1") + (F.least(F.greatest(y, F.least("e.y1", "e.y2")), F.greatest("e.y1", "e.y2")) - F.col("e.y1")) * (F.col("e.x2") - F.col("e.x1")) / F.when(~level, F.col("e.y2") - F.col("e.y1")))
    left, right = F.least(x_at(y0), x_at(y1), F.when(level, F.col("e.x2"))), F.greatest(x_at(y0), x_at(y1), F.when(level, F.col("e.x2")))
    spans = rows.select("by", "e", (number(left) - 1).alias("from"), (number(right) + 1).alias("to"))
    by_row = spans.groupBy("by").agg(F.collect_list(F.struct("e", "from", "to")).alias("s"))
    crossed = by_row.select("by", "s", F.explode(F.array_distinct(F.flatten(F.transform("s", lambda s: F.sequence(s["from"], s["to"]))))).alias("bx"))
    all_edges = F.transform("s", lambda s: s["e"])
    border = crossed.select("bx", "by", all_edges.alias("edges"))
    # stretches between crossed blocks of a row
    sorted_x = F.array_sort(F.array_distinct(F.flatten(F.transform("s", lambda s: F.sequence(s["from"], s["to"])))))
    gaps = by_row.select("by", "s", sorted_x.alias("xs")).withColumn("g", F.explode(F.filter(F.transform("xs", lambda x, i: F.struct((x + 1).alias("a"), (F.coalesce(F.get(F.col("xs"), i + 1), x) - 1).alias("b"))), lambda g: g["a"] <= g["b"])))
    probe = inside_polygon((F.col("g.a") + 0.5) * size, (F.col("by") + 0.5) * size, all_edges)
    inner = gaps.filter(probe).select(F.explode(F.sequence("g.a", "g.b")).alias("bx"), "by", F.lit(None).cast("array<struct<x1:double,y1:double,x2:double,y2:double>>").alias("edges"))
    return border.unionByName(inner)


def clip_blocks(blocks: DataFrame, edges: DataFrame, width: int, resolution: float, bands: tuple[str, ...]) -> DataFrame:
    """Blocks with the cells whose centre is outside the outline as null; blocks wholly outside are dropped, those wholly inside pass as they are."""
    from orbitgrain.operators.grid import inside_polygon

    outline = outline_blocks(edges, width, resolution).withColumnsRenamed({"bx": "_bx", "by": "_by", "edges": "_edges"})
    x = lambda i: (F.col("_bx") * width + i % width + 0.5) * resolution
    y = lambda i: (F.col("_by") * width + F.floor(i / width) + 0.5) * resolution
    # cells are tested once a place, not once a look
    keep = F.when(F.col("_edges").isNotNull(), F.transform(F.sequence(F.lit(0), F.lit(width * width - 1)), lambda i: inside_polygon(x(i), y(i), F.col("_edges"))))
    places = outline.groupBy("_bx", "_by").agg(F.first("_edges").alias("_edges")).select("_bx", "_by", keep.alias("_keep"))
    cut = blocks.join(places, (F.col("bx") == F.col("_bx")) & (F.col("by") == F.col("_by")))
    return cut.select(*(F.when(F.col("_keep").isNull() | F.col(c).isNull(), F.col(c)).otherwise(F.zip_with(c, "_keep", lambda v, k: F.when(k, v))).alias(c) if c in bands else F.col(c) for c in blocks.columns))
