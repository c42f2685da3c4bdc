"""Two access paths shared by the spatial operators.

``candidate_cells`` turns "cells near a pixel" into a generator: each pixel emits
the index window its radius covers. ``gather`` turns "pixels next to a pixel" into
one hash aggregation: each row is sent to the positions that look at it. Neither
sorts or collects a granule, so one granule holding most of the rows spreads over
all tasks like any other.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skygrid.plans.dimension import stored
from skygrid.plans.grid import GridSpec

# Slack, in cells, so that rounding never drops a cell on the rim; exact predicates follow.
_RIM = 1e-6


def offsets_array(offsets: Sequence[tuple[int, int]]) -> Column:
    return F.array(*[F.struct(F.lit(a).alias("dr"), F.lit(b).alias("dc"), F.lit(k).alias("pos"))
                     for k, (a, b) in enumerate(offsets)])


def window_cells(df: DataFrame, grid: GridSpec, lat_lo: Column, lat_hi: Column,
                 lon_lo: Column, lon_hi: Column) -> DataFrame:
    """One row per input row and grid cell whose centre lies in the row's own box."""
    first_lat = float(grid.lat0 + grid.i0 * grid.lat_step)
    first_lon = float(grid.lon0 + grid.j0 * grid.lon_step)

    def low(x: Column, first: float, step: float) -> Column:
        return F.greatest(F.ceil((x - F.lit(first)) / F.lit(step) - _RIM), F.lit(0).cast("long")).cast("int")

    def high(x: Column, first: float, step: float, n: int) -> Column:
        return F.least(F.floor((x - F.lit(first)) / F.lit(step) + _RIM), F.lit(n - 1).cast("long")).cast("int")

    boxed = df.withColumns({
        "_i": low(lat_lo, first_lat, grid.lat_step), "_j": low(lon_lo, first_lon, grid.lon_step),
        "_ni": high(lat_hi, first_lat, grid.lat_step, grid.nlat), "_nj": high(lon_hi, first_lon, grid.lon_step, grid.nlon),
    }).withColumns({"_ni": F.greatest(F.col("_ni") - F.col("_i") + 1, F.lit(0)),
                    "_nj": F.greatest(F.col("_nj") - F.col("_j") + 1, F.lit(0))})
    # The outer form keeps Spark from adding a filter that builds the same array again;
    # rows without a cell are dropped right after.
    n = F.col("_ni") * F.col("_nj")
    hits = boxed.withColumn("_k", F.explode_outer(F.when(n > 0, F.sequence(F.lit(0), n - 1))))
    cells = hits.where(F.col("_k").isNotNull()).withColumns({
        "i": F.col("_i") + F.expr("cast(_k div _nj as int)"),
        "j": F.col("_j") + F.col("_k") % F.col("_nj"),
    }).drop("_i", "_j", "_ni", "_nj", "_k")
    return cells.withColumns({"cell_lat": grid.lat_of(F.col("i")), "cell_lon": grid.lon_of(F.col("j"))})


def candidate_cells(pixels: DataFrame, grid: GridSpec, radius, lon_scale=1.0) -> DataFrame:
    """Pairs of a pixel and a cell at most ``radius`` degrees apart, with their distance ``d``.

    ``lon_scale`` shrinks longitude differences (cosine of a mean latitude). Both may
    be numbers or columns. The pairs per pixel are bounded by the radius, not by the data.
    """
    r = radius if isinstance(radius, Column) else F.lit(float(radius))
    s = lon_scale if isinstance(lon_scale, Column) else F.lit(float(lon_scale))
    lat, lon = F.col("lat"), F.col("lon")
    pairs = window_cells(pixels, grid, lat - r, lat + r, lon - r / s, lon + r / s)
    dx, dy = (lon - F.col("cell_lon")) * s, lat - F.col("cell_lat")
    return pairs.withColumn("d", F.sqrt(dy * dy + dx * dx)).where(F.col("d") <= r)


# Distances are told apart down to this part of a degree; closer ones are ties.
DISTANCE_UNIT = 1e-12


def nearest_per_cell(pairs: DataFrame, keys: Sequence[str], order: str, values: Sequence[str]) -> DataFrame:
    """The closest pixel of each cell; equal distances go to the smaller ``order`` (a whole number).

    Distance and order are one decimal, which a hash aggregate can hold; a struct would make Spark sort all pairs.
    """
    step = F.lit("20000000000000000000").cast("decimal(20,0)")
    rank = F.floor(F.col("d") / F.lit(DISTANCE_UNIT)).cast("decimal(17,0)") * step + F.col(order).cast("decimal(19,0)")
    picked = pairs.select(*keys, *values, "d", rank.cast("decimal(38,0)").alias("_rank"))
    return picked.groupBy(*keys).agg(*[F.min_by(v, "_rank").alias(v) for v in values], F.min_by("d", "_rank").alias("d"))


def _asked_blocks(pixels: DataFrame, grid: GridSpec, side: tuple[int, int]) -> DataFrame:
    """Each pixel once for every block of ``side`` cells that its window of half-width ``_r`` touches: ``_bi``, ``_bj``."""
    first_lat, first_lon = grid.lat_of(F.lit(0)), grid.lon_of(F.lit(0))

    def block(x: Column, first: Column, step: float, n: int, size: int) -> Column:
        cell = F.least(F.greatest(F.floor((x - first) / F.lit(step)), F.lit(0).cast("long")), F.lit(n - 1).cast("long"))
        return F.floor(cell / size).cast("int")

    def blocks(x: Column, r: Column, first: Column, step: float, n: int, size: int) -> Column:
        near = (x + r >= first - _RIM) & (x - r <= first + (n - 1) * F.lit(step) + _RIM)
        return F.when(near, F.sequence(block(x - r, first, step, n, size), block(x + r + step, first, step, n, size)))

    rows = pixels.withColumn("_bi", F.explode(blocks(F.col("lat"), F.col("_r"), first_lat, grid.lat_step, grid.nlat, side[0])))
    return rows.withColumn("_bj", F.explode(blocks(F.col("lon"), F.col("_r") / F.col("_s"), first_lon, grid.lon_step, grid.nlon, side[1])))


# Cells a task of a later round holds.
TASK_CELLS = 400_000


def _ring(pixels: DataFrame, best: DataFrame, grid: GridSpec, keys: Sequence[str], order: str, kept: Sequence[str], reach: float,
          counts: tuple[int, int]) -> DataFrame:
    """The closest pixels within ``reach`` (and a pixel's own radius): those of ``best`` in finished blocks, and of the others a new search.

    A block whose cells all have a pixel is finished. Pixels are sent to the other blocks their windows touch, and the windows are cut by
    block: so no cell of a finished block is made, none is made twice, and a block's pairs are reduced in the task that makes them. ``counts``,
    the pixels and the groups, bound the cells, by which the tasks are sized; Spark would size them by the pixels, which are far fewer.
    """
    side = (max(1, math.ceil(2 * reach / grid.lat_step)), max(1, math.ceil(2 * reach / grid.lon_step)))
    place = {"_bi": F.expr(f"cast(i div {side[0]} as int)"), "_bj": F.expr(f"cast(j div {side[1]} as int)")}
    cells = (F.least(F.lit(side[0]), F.lit(grid.nlat) - F.col("_bi") * side[0]) * F.least(F.lit(side[1]), F.lit(grid.nlon) - F.col("_bj") * side[1]))
    block, found = [*keys, "_bi", "_bj"], [*keys, "i", "j", *kept, "d"]
    placed = best.select(*found).withColumns(place)
    finished = stored(placed.groupBy(*block).agg(F.count("*").alias("_n")).where(F.col("_n") == cells).select(*block), "finished-blocks")
    window = (2 * reach / grid.lat_step + 1) * (2 * reach / grid.lon_step + 1)
    tasks = max(1, math.ceil(min(counts[0] * window, counts[1] * grid.size) / TASK_CELLS))
    asking = _asked_blocks(pixels.withColumn("_r", F.least(F.col("_radius"), F.lit(reach))), grid, side).repartition(tasks, *block)
    none = finished.isEmpty()
    if not none:
        asking = asking.join(finished.hint("merge"), block, "left_anti")

    def span(x: Column, r: Column, at: Column, step: float, size: int) -> tuple[Column, Column]:
        return (F.greatest(x - r, at - 0.25 * step),
                F.least(x + r, at + (F.lit(size) - 0.75) * F.lit(step)))

    r, s = F.col("_r"), F.col("_s")
    lat_lo, lat_hi = span(F.col("lat"), r, grid.lat_of(F.col("_bi") * side[0]), grid.lat_step, side[0])
    lon_lo, lon_hi = span(F.col("lon"), r / s, grid.lon_of(F.col("_bj") * side[1]), grid.lon_step, side[1])
    pairs = window_cells(asking, grid, lat_lo, lat_hi, lon_lo, lon_hi)
    dx, dy = (F.col("lon") - F.col("cell_lon")) * s, F.col("lat") - F.col("cell_lat")
    pairs = pairs.withColumn("d", F.sqrt(dy * dy + dx * dx)).where(F.col("d") <= r)
    # The block is part of the grouping key, so the exchange by block serves this aggregate too.
    searched = nearest_per_cell(pairs, [*block, "i", "j"], order, kept).select(*found)
    return searched if none else searched.unionByName(placed.join(finished.hint("merge"), block, "left_semi").select(*found))


# First radius of an outward search in cells, and its growth from round to round.
FIRST_RING, RING_GROWTH = 1.5, 4.0


def outward_nearest(pixels: DataFrame, grid: GridSpec, keys: Sequence[str], order: str, values: Sequence[str], radius,
                    most: float | None = None, lon_scale=1.0) -> DataFrame:
    """The closest pixel of each cell within ``radius`` degrees, searched outwards; equal distances go to the smaller ``order``.

    In a first round a pixel meets the few cells around it. A cell that finds a pixel within the radius of a round has found its
    closest one, since all pixels that near have met it. Blocks of cells that are all settled close, and pixels whose window reaches
    an open block search it again with a larger radius, cut to these blocks. So a dense swath makes a dozen pairs a pixel however far the
    search may go, and a coarse one little more than a single search. From the second round on pixels are shuffled, never pairs. A round that
    would stop short of the end by less than half its radius goes there at once. ``most`` bounds a radius that is a column.
    """
    r = radius if isinstance(radius, Column) else F.lit(float(radius))
    most = float(radius) if most is None else most
    reach = FIRST_RING * max(grid.lat_step, grid.lon_step)
    # A pixel without a radius takes part in the first round only.
    rows = pixels.select(*dict.fromkeys([*keys, order, *values, "lat", "lon"]), F.coalesce(r, F.lit(reach)).alias("_radius"),
                         (lon_scale if isinstance(lon_scale, Column) else F.lit(float(lon_scale))).alias("_s"))
    kept = list(dict.fromkeys([order, *values]))
    first = candidate_cells(rows.withColumn("_r", F.least(F.col("_radius"), F.lit(reach))), grid, F.col("_r"), F.col("_s"))
    best = nearest_per_cell(first, [*keys, "i", "j"], order, kept)
    counts = rows.agg(F.count("*"), F.approx_count_distinct(F.xxhash64(*keys))).first() if reach < most else None
    while reach < most:
        best = stored(best, "nearest-so-far")
        reach = most if reach * RING_GROWTH * 1.5 >= most else reach * RING_GROWTH
        best = _ring(rows, best, grid, keys, order, kept, reach, counts)
    return best.select(*keys, "i", "j", *values, "d")


def by_block(df: DataFrame, group: Sequence[str], row: str, col: str, side: int = 32) -> DataFrame:
    """Rows spread by blocks of ``side`` x ``side`` positions, named by ``_br`` and ``_bc``.

    Neighbours then mostly meet in one task, whose partial aggregate merges what they
    send each other: the next exchange carries little more than one row per position
    instead of one per neighbour. A block is small whatever the size of its granule.
    No number of partitions is given, so adaptive execution sizes the tasks.
    """
    placed = df.withColumns({"_br": F.expr(f"{row} div {side}"), "_bc": F.expr(f"{col} div {side}")})
    return placed.repartition(*group, "_br", "_bc")


def one_per_place(df: DataFrame, group: Sequence[str], row: str, col: str, values: Sequence[str], order: str = "pixel_id") -> DataFrame:
    """``by_block`` with a single row for each position: of several, the one of smallest ``order``.

    The block is part of the grouping key, so the exchange by block serves this aggregate too. Each value is picked on
    its own, which a hash aggregate can do in place.
    """
    key = [*group, "_br", "_bc", row, col]
    kept = (by_block(df.select(*group, row, col, order, *values), group, row, col)
            .groupBy(*key).agg(F.min(order).alias(order), *[F.min_by(v, order).alias(v) for v in values]))
    return kept.select(*group, row, col, order, *values)


def gather(df: DataFrame, group: Sequence[str], row: str, col: str,
           offsets: Mapping[str, tuple[int, int]], values: Sequence[str], own: str | None = None) -> DataFrame:
    """For every position, the ``values`` of the rows at the named offsets from it.

    Output columns are ``<name>_<value>``; a neighbour that does not exist gives null. With ``own``, a column whose distinct values at the position
    itself are listed, the rows are dealt by ``group`` already, in small groups, and meet no exchange; (0, 0) is then among the offsets.
    """
    names = list(offsets)
    rows = df.select(*group, row, col, *values, own) if own else by_block(df.select(*group, row, col, *values), group, row, col)
    sent = (rows.select(*group, row, col, *values, *([own] if own else []),
                    F.explode(offsets_array([offsets[n] for n in names])).alias("_o"))
            .withColumns({"_r": F.col(row) - F.col("_o.dr"), "_c": F.col(col) - F.col("_o.dc"),
                          "_pos": F.col("_o.pos")}))
    aggs = [F.max(F.when(F.col("_pos") == k, F.col(v))).alias(f"{name}_{v}")
            for k, name in enumerate(names) for v in values]
    if own:
        aggs.append(F.collect_set(F.when(F.col("_pos") == [offsets[n] for n in names].index((0, 0)), F.col(own))).alias(own))
    return (sent.groupBy(*group, F.col("_r").alias(row), F.col("_c").alias(col)).agg(*aggs))
