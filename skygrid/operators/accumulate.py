"""Gridded granules to daily, monthly and longer cubes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skygrid.functions.geo import finite, is_finite
from skygrid.functions.time import period_start
from skygrid.operators import moments
from skygrid.operators.regrid import adaptive_regrid, valid_pixels
from skygrid.plans.dimension import fact_table
from skygrid.plans.grid import GridSpec
from skygrid.sources.grids import write_on_grid
from skygrid.sources.tables import cube_layout, write_cube


def weighted_stats(value: Column, weight: Column) -> tuple[Column, Column, Column]:
    """Aggregates ``mean, count, std`` of one cell in a single pass, for streams; weight counts only where the value exists.

    The spread is a difference of squares, which loses digits where it is far smaller than the mean; ``accumulate`` does not.
    """
    w = F.when(is_finite(value), weight).otherwise(0.0)
    v = F.coalesce(finite(value), F.lit(0.0))
    mean = F.try_divide(F.sum(w * v), F.sum(w))
    spread = F.try_divide(F.sum(w * v * v), F.sum(w)) - mean * mean
    return mean, F.count_if(w > 0), F.sqrt(F.greatest(spread, F.lit(0.0)))


def accumulate(cells: DataFrame, keys=()) -> DataFrame:
    """Per cell over granules: count-weighted mean, number of granules, weighted std."""
    return moments.finished(moments.merged(moments.states_of(cells, keys), keys))


def period_bucket(cells: DataFrame, period: str, time: str = "time") -> DataFrame:
    """``accumulate`` per day, fortnight, month, season or year."""
    return accumulate(cells.withColumn("period", period_start(F.col(time), period)), ("period",))


def period_buckets(cells: DataFrame, periods=moments.PERIODS, time: str = "time") -> DataFrame:
    """``period_bucket`` for several period lengths (bucket, period) out of one reading: days first, the others from the days."""
    days = moments.merged(moments.states_of(cells, [F.to_date(time).alias("obs_date")]), ("obs_date",))
    return moments.finished(moments.rolled_up(days, periods))


def tile_mean(tiles: DataFrame, keys=("obs_date",), order: str = "granule_id", legacy: bool = False) -> DataFrame:
    """Tiles of one day combined per cell: the mean of the valid values.

    ``legacy`` counts the first valid tile twice when the day has several tiles, as
    older cubes did.
    """
    valid = finite(F.col("value"))
    if not legacy:
        return (tiles.groupBy(*keys, "i", "j").agg(F.avg(valid).alias("value"))
                .where(F.col("value").isNotNull()))
    days = tiles.select(*keys, order).distinct().groupBy(*keys).agg(F.count("*").alias("_tiles"))
    cells = (tiles.where(is_finite(F.col("value"))).groupBy(*keys, "i", "j")
             .agg(F.sum("value").alias("_s"), F.count("*").alias("_n"), F.min_by("value", order).alias("_first")))
    twice = (F.col("_s") + F.col("_first")) / (F.col("_n") + 1)
    return cells.join(days, list(keys)).select(
        *keys, "i", "j", F.when(F.col("_tiles") > 1, twice).otherwise(F.col("_s")).alias("value"))


def tile_overlay(tiles: DataFrame, keys=("obs_date",), order: str = "granule_id") -> DataFrame:
    """A later tile replaces an earlier one wherever it is valid."""
    return (tiles.where(is_finite(F.col("value"))).groupBy(*keys, "i", "j")
            .agg(F.max_by("value", order).alias("value")))


def first_fill(pixels: DataFrame, grid: GridSpec, keys=("granule_id",)) -> DataFrame:
    """The first pixel whose truncated index is a cell fills it; points beyond the centres are left out."""
    lat_first, lon_first = grid.lat_of(F.lit(0)), grid.lon_of(F.lit(0))
    lat_last, lon_last = grid.lat_of(F.lit(grid.nlat - 1)), grid.lon_of(F.lit(grid.nlon - 1))

    def index(x: Column, first: Column, step: float, n: int) -> Column:
        return F.least(F.floor((x - first) / F.lit(float(step))), F.lit(n - 1).cast("long")).cast("int")

    inside = F.col("lat").between(lat_first, lat_last) & F.col("lon").between(lon_first, lon_last)
    return (valid_pixels(pixels).where(inside)
            .withColumns({"i": index(F.col("lat"), lat_first, grid.lat_step, grid.nlat),
                          "j": index(F.col("lon"), lon_first, grid.lon_step, grid.nlon)})
            .groupBy(*keys, "i", "j").agg(F.min_by("value", "pixel_id").alias("value")))


def daily_cube(pixels: DataFrame, grid: GridSpec, legacy_mean: bool = False) -> DataFrame:
    """Every granule of a day gridded on its own, then combined per cell."""
    days = fact_table(pixels.groupBy("granule_id").agg(F.to_date(F.min("obs_time")).alias("obs_date")), "days")
    tiles = adaptive_regrid(pixels, grid).join(days, "granule_id")
    return grid.with_coordinates(tile_mean(tiles, legacy=legacy_mean))


def monthly_cubes(pixels: DataFrame, grid: GridSpec, path: str, **attributes) -> None:
    """The daily cube written below ``path``, one output for each month with data; months that are written again are replaced.

    ``attributes`` (hub, product, level, region, units, ...) describe the cube; its grid is registered beside it. ``scan_cube`` reads it.
    """
    days = daily_cube(pixels, grid).withColumns({"time": F.col("obs_date").cast("timestamp"), "slice_id": F.col("obs_date").cast("string")})
    write_on_grid(cube_layout(days.drop("obs_date"), **attributes), grid, path, write_cube)
