"""Station time series out of cubes and reanalysis fields."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skygrid.functions.geo import deg_distance, finite, in_box
from skygrid.functions.time import local_day_window, to_local
from skygrid.plans.dimension import BROADCAST_ROWS
from skygrid.plans.grid import GridSpec
from skygrid.plans.neighbours import offsets_array

# Row-major 3 x 3 neighbourhood; position 4 is the centre.
AROUND = [(a, b) for a in (-1, 0, 1) for b in (-1, 0, 1)]
FAR_DEG = 0.1


def nearest_cell(stations: DataFrame, grid: GridSpec) -> DataFrame:
    """Grid indices, centre, distance and a flag for stations far from any centre.

    On a regular grid the closest row and column are arithmetic, so this is a
    projection: no station meets a table of cells.
    """
    found = stations.withColumns({"i": grid.nearest_row(F.col("lat")), "j": grid.nearest_col(F.col("lon"))})
    found = found.withColumns({"cell_lat": grid.lat_of(F.col("i")), "cell_lon": grid.lon_of(F.col("j"))})
    distance = deg_distance(F.col("lat"), F.col("lon"), F.col("cell_lat"), F.col("cell_lon"))
    return found.withColumn("distance", distance).withColumn("far", F.col("distance") > FAR_DEG)


def _frame(cube: DataFrame, cells: DataFrame, time_keys: Sequence[str]) -> DataFrame:
    """Every time of the cube for every station; the stations ride along as one array."""
    return _for_every_station(cube.select(*time_keys).distinct(), cells)


def _for_every_station(times: DataFrame, stations: DataFrame) -> DataFrame:
    """Each row of ``times`` once for each station. The names travel as one literal array, so their number is checked."""
    names = stations.select("station").distinct()
    if (n := names.count()) > BROADCAST_ROWS:
        raise ValueError(f"{n} stations; at most {BROADCAST_ROWS} may be framed at once")
    return times.withColumn("station", F.explode(names.agg(F.collect_list("station")).scalar()))


def extract_point(cube: DataFrame, stations: DataFrame, grid: GridSpec, time_keys=("time",)) -> DataFrame:
    """Value at each station's nearest cell, one row per time and station, null where empty."""
    cells = nearest_cell(stations, grid).select("station", "i", "j")
    hits = (cube.join(cells, ["i", "j"]).groupBy(*time_keys, "station").agg(F.max(finite(F.col("value"))).alias("value")))
    return _frame(cube, cells, time_keys).join(hits, [*time_keys, "station"], "left")


def extract_3x3(cube: DataFrame, stations: DataFrame, grid: GridSpec, time_keys=("time",)) -> DataFrame:
    """Nine cells around each station (``grid_0`` .. ``grid_8``), their mean and population std."""
    cells = (nearest_cell(stations, grid).select("station", "i", "j")
             .withColumn("_o", F.explode(offsets_array(AROUND)))
             .select("station", (F.col("i") + F.col("_o.dr")).alias("i"), (F.col("j") + F.col("_o.dc")).alias("j"),
                     F.col("_o.pos").alias("pos"))
             .where(F.col("i").between(0, grid.nlat - 1) & F.col("j").between(0, grid.nlon - 1)))
    value = finite(F.col("value"))
    hits = cube.join(cells, ["i", "j"]).groupBy(*time_keys, "station").agg(
        *[F.max(F.when(F.col("pos") == k, value)).alias(f"grid_{k}") for k in range(9)],
        F.avg(value).alias("mean"), F.stddev_pop(value).alias("std"))
    return _frame(cube, cells, time_keys).join(hits, [*time_keys, "station"], "left")


def fill_missing_dates(series: DataFrame, stations: DataFrame, start: str, end: str) -> DataFrame:
    """Null rows for the dates in [start, end] on which the series has no row at all."""
    spark = series.sparkSession
    days = spark.sql("select explode(sequence(to_date(:s), to_date(:e))) as _d", args={"s": start, "e": end})
    gone = days.join(series.select(F.to_date("time").alias("_d")).distinct(), "_d", "left_anti")
    filler = _for_every_station(gone.select(F.col("_d").cast("timestamp").alias("time")), stations)
    return series.unionByName(filler, allowMissingColumns=True)


def pivot_wide(series: DataFrame, names: Sequence[str], columns: Sequence[str] = ("value",),
               keys=("time",)) -> DataFrame:
    """One row per time; stations by name, each with its value columns.

    The names are given, so no job runs to find them, and a pivot is one hash aggregation.
    """
    single, names = len(columns) == 1, sorted(names)
    # A number in place of the name, so that the code of many columns stays small enough to be compiled.
    numbered = series.select(*keys, *columns, F.array_position(F.array(*[F.lit(n) for n in names]), F.col("station")).cast("int").alias("_n"))
    aggs = [F.max(F.when(F.col("_n") == k, F.col(c))).alias(n if single else f"{n}_{c}")
            for k, n in enumerate(names, 1) for c in columns]
    return numbered.groupBy(*keys).agg(*aggs)


SURROUNDING = tuple(f"grid_{k}" for k in range(9)) + ("mean", "std")


def completeness(series: DataFrame, value: str = "value") -> DataFrame:
    """Filled and possible values per station, and overall in the row ``(all)``."""
    return (series.rollup("station").agg(F.count(value).alias("valid"), F.count("*").alias("possible"))
            .select(F.coalesce("station", F.lit("(all)")).alias("station"), "valid", "possible",
                    F.try_divide(F.col("valid") * 100.0, F.col("possible")).alias("percent")))


def station_series(fields: DataFrame, stations: DataFrame, grid: GridSpec, start: str, end: str,
                   tz: str = "Asia/Taipei", surrounding: bool = False) -> DataFrame:
    """Per variable and level: local-time series of the local days in [start, end]."""
    window = fields.where(local_day_window(F.col("time_utc"), start, end, tz))
    take = extract_3x3 if surrounding else extract_point
    series = take(window, stations, grid, ("variable", "level_key", "time_utc"))
    return series.withColumn("time_local", to_local(F.col("time_utc"), tz))


def with_level_key(fields: DataFrame) -> DataFrame:
    """Surface fields have no level; a text key lets them be grouped and joined like the others."""
    return fields.withColumn("level_key", F.coalesce(F.col("level").cast("string"), F.lit("sfc")))


def analyze_3x3(series: DataFrame) -> DataFrame:
    """Nine columns as a 3 x 3 matrix, with the number of valid cells and the centre."""
    cells = F.array(*[F.col(f"grid_{k}") for k in range(9)])
    matrix = F.array(*[F.slice(cells, 3 * k + 1, 3) for k in range(3)])
    return series.withColumns({"matrix": matrix, "valid_points": F.size(F.filter(cells, lambda x: x.isNotNull())),
                               "center_value": F.element_at(cells, 5)})


def count_in_box(places: DataFrame, bounds, keys: Sequence[str]) -> DataFrame:
    """Places inside a box, counted by their attributes."""
    return places.where(in_box(F.col("lat"), F.col("lon"), bounds)).groupBy(*keys).agg(F.count("*").alias("n"))


def select_stations(places: DataFrame, names: Sequence[str] | str = "all", column: str = "station") -> DataFrame:
    return places if names == "all" else places.where(F.col(column).isin(*names))


def expected_slots(keys: DataFrame, start: Column, end: Column, minutes: int, limit: int | None = None) -> DataFrame:
    """Regular times from start to end, both included, for every row of ``keys``."""
    step = F.make_dt_interval(mins=F.lit(minutes))
    slots = F.sequence(start, end, step)
    return keys.withColumn("time_utc", F.explode(slots if limit is None else F.slice(slots, 1, limit)))
