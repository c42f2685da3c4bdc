"""The grids of stored cubes as a small table: every slice names its grid, and the grid says its axes."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skygrid.plans.grid import GridSpec
from skygrid.sources.tables import rebuild_partitions

FIELDS = "lat0 double, lat_step double, nlat int, lon0 double, lon_step double, nlon int, i0 int, j0 int"
MAX_GRIDS = 10_000


def grid_id(grid: GridSpec) -> str:
    """Name of a grid by its signature: grids whose cells may be merged share it."""
    return "_".join([f"{grid.nlat}x{grid.nlon}", *(f"{x:.6f}" for x in grid.signature()[2:])])


def register_grid(spark: SparkSession, path: str, grid: GridSpec) -> str:
    """Keeps a grid in the table below ``path`` and returns its name. A grid that is there already replaces itself."""
    name = grid_id(grid)
    row = (float(grid.lat0), float(grid.lat_step), grid.nlat, float(grid.lon0), float(grid.lon_step), grid.nlon, grid.i0, grid.j0, name)
    rebuild_partitions(spark.createDataFrame([row], f"{FIELDS}, grid_id string"), path, ("grid_id",))
    return name


def read_grids(spark: SparkSession, path: str) -> dict[str, GridSpec]:
    """All grids of the table by name; a table that does not exist has none."""
    try:
        rows = spark.read.schema(f"{FIELDS}, grid_id string").parquet(path).limit(MAX_GRIDS + 1).collect()
    except AnalysisException as missing:
        if "PATH_NOT_FOUND" in str(missing):
            return {}
        raise
    if len(rows) > MAX_GRIDS:
        raise ValueError(f"more than {MAX_GRIDS} grids below {path}")
    return {r["grid_id"]: GridSpec(*[r[c] for c in ("lat0", "lat_step", "nlat", "lon0", "lon_step", "nlon", "i0", "j0")]) for r in rows}


def write_on_grid(cube: DataFrame, grid: GridSpec, path: str, write) -> None:
    """``cube`` (from ``cube_layout``) written by ``write(cube, path)`` with the name of its grid, which is registered beside it."""
    name = register_grid(cube.sparkSession, grids_path(path), grid)
    write(cube.withColumn("grid_id", F.lit(name)), path)


def grids_path(cube_path: str) -> str:
    """Where the grids of a cube are kept; the leading underscore hides them from scans of the cube."""
    return f"{cube_path.rstrip('/')}/_grids"


def grids_in(cube: DataFrame, grids: Mapping[str, GridSpec]) -> set[str]:
    """Names of the grids that ``cube`` has rows on; a row without a grid, or with one not in ``grids``, is an error."""
    found = {r[0] for r in cube.select("grid_id").distinct().limit(len(grids) + 1).collect()}
    if stray := found - set(grids):
        raise ValueError(f"rows on grids that are not registered: {sorted(map(str, stray))}")
    return found
