"""Share of a region observed per slice, day, month and year."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skygrid.functions.geo import cell_weight, is_finite
from skygrid.functions.numbers import mean_of_rounded, round_even
from skygrid.functions.time import bucket_label, in_date_range
from skygrid.operators.region import box_of, region_cells, restrict_to_region
from skygrid.plans.cellmaps import cell_words, covered_weight, region_words, union_words
from skygrid.plans.grid import GridSpec
from skygrid.sources.grids import grids_in
from skygrid.sources.tables import rebuild_partitions

COLUMNS = ("hub", "product", "region", "time", "granularity", "weight", "valid", "total", "coverage", "n_slices")


def coverage_total(grid: GridSpec, region, weight: str = "count", spark=None,
                   vertices: DataFrame | None = None) -> Column:
    """Weight of all region cells, observed or not.

    For a box this is arithmetic on the two axes; for a zone a scalar subquery over its mask.
    """
    bounds = box_of(region, vertices)
    if bounds is None:
        cells = region_cells(grid, region, spark, vertices)
        return cells.agg(F.coalesce(F.sum(cell_weight(F.col("lat"), weight)), F.lit(0.0))).scalar()
    lats, lons = grid.lats(), grid.lons()
    rows = lats[(lats >= bounds[2]) & (lats <= bounds[3])]
    cols = int(((lons >= bounds[0]) & (lons <= bounds[1])).sum())
    if weight not in ("count", "area"):
        raise ValueError("weight must be 'count' or 'area'")
    per_column = float(np.cos(np.radians(rows)).sum()) if weight == "area" else float(rows.size)
    return F.lit(per_column * cols)


def grid_signature(cube: DataFrame, slice_keys=("slice_id",)) -> DataFrame:
    """Extent of the observed cells of every slice, one line per slice: two slices of one grid may differ."""
    return cube.groupBy(*slice_keys).agg(
        (F.max("i") - F.min("i") + 1).alias("n_rows"), (F.max("j") - F.min("j") + 1).alias("n_cols"),
        *[f(c).alias(f"{c}_{n}") for c in ("lat", "lon") for n, f in (("min", F.min), ("max", F.max))])


def off_grid_cells(cube: DataFrame, grid: GridSpec, tolerance: float = 1e-6) -> DataFrame:
    """Cells whose stored position is not the grid's own position for their index."""
    return cube.where((F.abs(F.col("lat") - grid.lat_of(F.col("i"))) > tolerance)
                      | (F.abs(F.col("lon") - grid.lon_of(F.col("j"))) > tolerance)
                      | ~F.col("i").between(0, grid.nlat - 1) | ~F.col("j").between(0, grid.nlon - 1))


def on_grid(cube: DataFrame, grid: GridSpec, tolerance: float = 1e-6) -> DataFrame:
    """``cube``, raising at the first measured cell whose stored position is not the grid's: rows of another grid are
    refused in the pass that counts them. A cube without stored positions cannot be told apart."""
    if not {"lat", "lon"} <= set(cube.columns):
        return cube
    ok = ((F.abs(F.col("lat") - grid.lat_of(F.col("i"))) <= tolerance)
          & (F.abs(F.col("lon") - grid.lon_of(F.col("j"))) <= tolerance))
    stray = F.raise_error(F.lit("the product mixes grids; point it at one cube")).cast("boolean")
    # A filter, since a column could be pruned away with its check.
    return cube.where(F.when(F.coalesce(ok, F.lit(True)), F.lit(True)).otherwise(stray))


def assert_single_grid(cube: DataFrame, grid: GridSpec) -> None:
    """Raise when a product mixes grids; stops at the first stray cell."""
    if off_grid_cells(cube, grid).limit(1).count():
        raise ValueError("the product mixes grids; point it at one cube")


def _tidy(df: DataFrame, hub: str, product: str, region, granularity: str, weight: str, coverage: Column) -> DataFrame:
    name = region if isinstance(region, str) else "box"
    return df.select(
        F.lit(hub).alias("hub"), F.lit(product).alias("product"), F.lit(name).alias("region"),
        bucket_label(F.col("_t"), granularity).alias("time"), F.lit(granularity).alias("granularity"),
        F.lit(weight).alias("weight"), round_even(F.col("valid"), 3).alias("valid"),
        round_even(F.col("total"), 3).alias("total"), round_even(coverage, 5).alias("coverage"), F.col("n_slices").cast("long").alias("n_slices"))


def compute_coverage(cube: DataFrame, grid: GridSpec, *, region="taiwan", start=None, end=None,
                     granularity: str = "daily", weight: str = "count", hub: str = "", product: str = "",
                     slice_key: str = "slice_id", vertices: DataFrame | None = None,
                     slices: DataFrame | None = None) -> DataFrame:
    """Tidy coverage table over ``cube`` rows ``(slice_key, time, i, j, value)``.

    A cell is covered on a day when any slice of that day has a value there. Slices
    without any valid cell still make their day appear; they come from ``slices`` when
    the caller keeps such a table, else from two narrow columns of the cube.
    """
    if start is not None or end is not None:
        span = in_date_range(F.col("time"), start or "0001-01-01", end or "9999-12-31")
        cube = cube.where(span)
        slices = slices.where(span) if slices is not None else None
    total = coverage_total(grid, region, weight, cube.sparkSession, vertices)
    known = cube if slices is None else slices
    known = known.select(slice_key, "time").distinct()
    valid = on_grid(restrict_to_region(cube.where(is_finite(F.col("value"))), grid, region, vertices), grid)

    if granularity == "per_file":
        seen = covered_weight(cell_words(valid, [slice_key, "time"]), grid, [slice_key, "time"], weight)
        rows = known.join(seen, [slice_key, "time"], "left").select(
            slice_key, F.col("time").alias("_t"), F.coalesce("valid", F.lit(0.0)).alias("valid"),
            total.alias("total"), F.lit(1).alias("n_slices"))
        return _tidy(rows, hub, product, region, granularity, weight, F.try_divide(F.col("valid"), F.col("total")))

    # The union over a day is combined map-side; a task sends one word for 64 neighbouring cells.
    day = F.to_date("time").alias("_t")
    days = known.groupBy(day).agg(F.count("*").alias("n_slices"))
    words = cell_words(valid, [day])
    return _by_day(words, days, total, grid, region, granularity, weight, hub, product)


def _by_day(words: DataFrame, days: DataFrame, total: Column, grid: GridSpec, region, granularity: str, weight: str,
            hub: str, product: str) -> DataFrame:
    """Daily to yearly rows from words (_t, i, w, bits) inside the region and the days (_t, n_slices)."""
    ratio = F.try_divide(F.col("valid"), F.col("total"))
    daily = days.join(covered_weight(words, grid, ["_t"], weight), "_t", "left").select(
        "_t", "n_slices", F.coalesce("valid", F.lit(0.0)).alias("valid"), total.alias("total"))
    if granularity == "daily":
        return _tidy(daily, hub, product, region, granularity, weight, ratio)

    units = {"monthly": "month", "yearly": "year"}
    if granularity not in units:
        raise ValueError("granularity must be per_file, daily, monthly or yearly")
    # Means are taken over the already rounded daily rows.
    rounded = daily.select(F.date_trunc(units[granularity], "_t").alias("_t"), "n_slices",
                           round_even(F.col("valid"), 3).alias("valid"), "total", round_even(ratio, 5).alias("coverage"))
    rows = rounded.groupBy("_t").agg(
        mean_of_rounded(F.col("valid"), 3).alias("valid"), F.first("total").alias("total"),
        mean_of_rounded(F.col("coverage"), 5).alias("_cov"), F.sum("n_slices").alias("n_slices"))
    return _tidy(rows, hub, product, region, granularity, weight, F.col("_cov"))


def coverage_by_grid(cube: DataFrame, grids: Mapping[str, GridSpec], *, granularity: str = "per_file", **options) -> DataFrame:
    """``compute_coverage`` of a cube whose rows name their grid (``grid_id``), out of the registered ``grids``.

    ``per_file`` measures each slice by the mask and the total of its own grid. The other granularities join slices cell by cell and
    need a single grid: the rows themselves are looked at, and several grids, or one that is not registered, are an error.
    """
    found = sorted(grids_in(cube, grids))
    if granularity != "per_file" and len(found) > 1:
        raise ValueError(f"the product mixes grids ({', '.join(found)}); point it at one cube")
    if not found:
        return compute_coverage(cube, next(iter(grids.values())), granularity=granularity, **options)
    parts = [compute_coverage(cube.where(F.col("grid_id") == name), grids[name], granularity=granularity, **options) for name in found]
    return reduce(DataFrame.unionByName, parts)


# -- coverage kept as a table ------------------------------------------------------

MAP_PARTITIONS = ("yyyy", "batch")


def _dated(df: DataFrame, batch: str) -> DataFrame:
    return df.withColumns({"yyyy": F.date_format("obs_date", "yyyy"), "batch": F.lit(batch)})


def add_to_map(cube: DataFrame, grid: GridSpec, path: str, batch: str, slice_key: str = "slice_id") -> None:
    """Adds slices to the coverage map below ``path``: the cells of each day as words, and the slices of each day.

    The map holds the whole grid, so any region and weight can be asked for later. A batch writes its own partitions and
    replaces them when repeated; slices that come again, in any batch, change nothing.
    """
    valid = on_grid(cube.where(is_finite(F.col("value")) & F.col("i").between(0, grid.nlat - 1) & F.col("j").between(0, grid.nlon - 1)), grid)
    day = F.to_date("time").alias("obs_date")
    slices = cube.select(day, F.col(slice_key).cast("string").alias("slice")).distinct()
    rebuild_partitions(_dated(cell_words(valid, [day]), batch), f"{path}/words", MAP_PARTITIONS)
    rebuild_partitions(_dated(slices, batch), f"{path}/slices", MAP_PARTITIONS)


MAP_TABLES = {"words": "i int, w int, bits long", "slices": "slice string"}


def _stored(spark, path: str, table: str, start=None, end=None) -> DataFrame:
    stored = spark.read.schema(f"obs_date date, {MAP_TABLES[table]}, yyyy string, batch string").parquet(f"{path}/{table}")
    if start is not None or end is not None:
        start, end = start or "0001-01-01", end or "9999-12-31"
        years = [F.date_format(F.lit(x).cast("timestamp"), "yyyy") for x in (start, end)]
        stored = stored.where(F.col("yyyy").between(*years) & in_date_range(F.col("obs_date").cast("timestamp"), start, end))
    return stored.drop("yyyy", "batch")


def coverage_from_map(spark, path: str, grid: GridSpec, *, region="taiwan", start=None, end=None, granularity: str = "daily",
                      weight: str = "count", hub: str = "", product: str = "", vertices: DataFrame | None = None) -> DataFrame:
    """``compute_coverage`` by day, month or year from a coverage map, without reading the cube again."""
    words = _stored(spark, path, "words", start, end)
    words = union_words(region_words(words, grid, region, vertices), ["obs_date"]).withColumnRenamed("obs_date", "_t")
    days = (_stored(spark, path, "slices", start, end).distinct()
            .groupBy(F.col("obs_date").alias("_t")).agg(F.count("*").alias("n_slices")))
    total = coverage_total(grid, region, weight, spark, vertices)
    return _by_day(words, days, total, grid, region, granularity, weight, hub, product)


def compact_map(spark, path: str, to: str, batch: str = "base") -> None:
    """The map below ``path`` written below ``to`` as one batch, one row for each day and word; later batches go there."""
    rebuild_partitions(_dated(union_words(_stored(spark, path, "words"), ["obs_date"]), batch), f"{to}/words", MAP_PARTITIONS)
    rebuild_partitions(_dated(_stored(spark, path, "slices").distinct(), batch), f"{to}/slices", MAP_PARTITIONS)


def coverage_summary(coverage: DataFrame) -> DataFrame:
    """Mean coverage, number of buckets and number of slices."""
    return coverage.agg(mean_of_rounded(F.col("coverage"), 5).alias("mean_coverage"), F.count("*").alias("buckets"),
                        F.coalesce(F.sum("n_slices"), F.lit(0)).alias("slices"))


def temporal_availability(observed: DataFrame, slots: DataFrame, keys=("variable",), time: str = "time_utc") -> DataFrame:
    """Slots with data over slots expected, per key; ``slots`` holds every key and expected time."""
    present = observed.select(*keys, time).distinct().withColumn("_hit", F.lit(1))
    return (slots.join(present, [*keys, time], "left").groupBy(*keys)
            .agg(F.count("_hit").alias("present"), F.count("*").alias("expected"))
            .withColumn("availability", F.try_divide(F.col("present"), F.col("expected"))))
