"""Which cells belong to a region: boxes by predicate, zones by scanline fill."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skygrid.functions.geo import in_box
from skygrid.functions.lookup import AIR_QUALITY_ZONES, REGIONS
from skygrid.plans.dimension import hint_if_bounded
from skygrid.plans.grid import GridSpec


def box_of(region, vertices: DataFrame | None = None) -> tuple[float, float, float, float] | None:
    """Bounds of a named box or of a tuple; None for a zone; anything else is an error.

    With outlines at hand, any zone name they hold may be asked for.
    """
    if isinstance(region, tuple):
        return region
    if vertices is not None:
        return None
    if region in REGIONS:
        return REGIONS[region]
    if region in AIR_QUALITY_ZONES:
        return None
    raise ValueError(f"unknown region {region!r}; boxes: {sorted(REGIONS)}; zones: {sorted(AIR_QUALITY_ZONES)}")


def zone_mask(vertices: DataFrame, grid: GridSpec) -> DataFrame:
    """Cells whose centre lies in a zone, the union of its counties: ``zone, i, j``.

    Every polygon edge emits the grid rows it crosses and the longitude of the
    crossing. Sorted along a row, crossings pair up into inside intervals (even-odd
    rule, so inner rings are holes) and each interval emits its cells. The work is
    edges plus covered cells; cells and edges are never paired up.
    """
    ring = Window.partitionBy("zone", "county", "ring").orderBy("seq")
    edges = (vertices.withColumns({"lat2": F.lead("lat").over(ring), "lon2": F.lead("lon").over(ring)})
             .where(F.col("lat2").isNotNull() & (F.col("lat") != F.col("lat2"))))
    first_lat, first_lon = float(grid.lats()[0]), float(grid.lons()[0])
    low, high = F.least("lat", "lat2"), F.greatest("lat", "lat2")
    rows = (edges.withColumns({
        "_a": F.greatest(F.ceil((low - first_lat) / grid.lat_step - 1e-6), F.lit(0).cast("long")),
        "_b": F.least(F.floor((high - first_lat) / grid.lat_step + 1e-6), F.lit(grid.nlat - 1).cast("long"))})
        .where(F.col("_a") <= F.col("_b")).withColumn("i", F.explode(F.sequence(F.col("_a").cast("int"), F.col("_b").cast("int")))))
    y = grid.lat_of(F.col("i"))
    # Half-open in latitude: a vertex on a row belongs to one of its two edges only.
    crossing = rows.where((y >= low) & (y < high)).select(
        "zone", "county", "i",
        (F.col("lon") + (y - F.col("lat")) / (F.col("lat2") - F.col("lat")) * (F.col("lon2") - F.col("lon"))).alias("x"))
    along = Window.partitionBy("zone", "county", "i").orderBy("x")
    spans = (crossing.withColumns({"_rn": F.row_number().over(along), "x2": F.lead("x").over(along)})
             .where((F.col("_rn") % 2 == 1) & F.col("x2").isNotNull()))
    cells = (spans.withColumns({
        "_a": F.greatest(F.ceil((F.col("x") - first_lon) / grid.lon_step - 1e-6), F.lit(0).cast("long")),
        "_b": F.least(F.floor((F.col("x2") - first_lon) / grid.lon_step + 1e-6), F.lit(grid.nlon - 1).cast("long"))})
        .where(F.col("_a") <= F.col("_b")).withColumn("j", F.explode(F.sequence(F.col("_a").cast("int"), F.col("_b").cast("int")))))
    lon = grid.lon_of(F.col("j"))
    return cells.where((lon >= F.col("x")) & (lon < F.col("x2"))).select("zone", "i", "j").distinct()


def region_cells(grid: GridSpec, region, spark, vertices: DataFrame | None = None) -> DataFrame:
    """Cells of one region with coordinates; zones need the county outlines."""
    bounds = box_of(region, vertices)
    if bounds is not None:
        return grid.cells(spark).where(in_box(F.col("lat"), F.col("lon"), bounds))
    if vertices is None:
        raise ValueError("a zone needs its county outlines")
    mask = zone_mask(vertices.where(F.col("zone") == region), grid).drop("zone")
    return grid.with_coordinates(mask)


def restrict_to_region(cube: DataFrame, grid: GridSpec, region, vertices: DataFrame | None = None) -> DataFrame:
    """Cube rows inside a region: for a box a range of rows and columns, which reaches the scan; a semi-join for a zone."""
    bounds = box_of(region, vertices)
    if bounds is not None:
        lats, lons = grid.lats(), grid.lons()
        spans = [(lats >= bounds[2]) & (lats <= bounds[3]), (lons >= bounds[0]) & (lons <= bounds[1])]
        for name, inside in zip(("i", "j"), spans):
            places = inside.nonzero()[0]
            cube = cube.where(F.col(name).between(int(places[0]), int(places[-1])) if places.size else F.lit(False))
        return cube
    mask = region_cells(grid, region, cube.sparkSession, vertices).select("i", "j")
    return cube.join(hint_if_bounded(mask, grid.size), ["i", "j"], "left_semi")
