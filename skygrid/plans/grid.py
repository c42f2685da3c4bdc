"""Regular longitude/latitude grids.

A grid is six numbers (plus the offset of a crop in its parent), so every cell
coordinate, edge and index is column arithmetic: no grid table is joined to find
the cell of a pixel. Coordinates are always ``origin + index * step``.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, replace

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Kilometres per degree of latitude, Earth radius in km, and the
# latitude beyond which a longitude degree is treated as having no length.
KM_PER_DEG_LAT = 111.32
EARTH_RADIUS_KM = 6371.0
POLAR_LIMIT_DEG = 89.9

# Default resolution (x km, y km) and boxes (lon_min, lon_max, lat_min, lat_max).
DEFAULT_RESOLUTION_KM = (5.5, 3.5)
TAIWAN_BOX = (118.0, 124.0, 20.0, 27.0)
FIGURE_BOX = (119.0, 123.0, 21.0, 26.0)
FILTER_BOX = (120.0, 122.0, 22.0, 25.0)

Bounds = tuple[float, float, float, float]


def km_to_deg_lat(km: float) -> float:
    return km / KM_PER_DEG_LAT


def km_to_deg_lon(km: float, latitude: float) -> float:
    if abs(latitude) > POLAR_LIMIT_DEG:
        return 0.0
    return km / (EARTH_RADIUS_KM * math.cos(math.radians(latitude)) * 2 * math.pi / 360)


def _axis_length(start: float, stop: float, step: float) -> int:
    return max(0, math.ceil((stop - start) / step))


@dataclass(frozen=True)
class GridSpec:
    """Cell centres ``lat0 + (i + i0) * lat_step`` and ``lon0 + (j + j0) * lon_step``."""

    lat0: float
    lat_step: float
    nlat: int
    lon0: float
    lon_step: float
    nlon: int
    i0: int = 0
    j0: int = 0

    # -- construction ---------------------------------------------------------
    @classmethod
    def from_km(cls, resolution=DEFAULT_RESOLUTION_KM, bounds: Bounds = TAIWAN_BOX) -> GridSpec:
        """Steps from kilometres: latitude at a constant rate, longitude at the centre latitude."""
        lon_min, lon_max, lat_min, lat_max = bounds
        lon_step = km_to_deg_lon(resolution[0], (lat_max + lat_min) / 2)
        lat_step = km_to_deg_lat(resolution[1])
        if lon_step <= 0 or lat_step <= 0:
            raise ValueError("grid step must be positive")
        return cls(lat_min, lat_step, _axis_length(lat_min, lat_max + lat_step, lat_step),
                   lon_min, lon_step, _axis_length(lon_min, lon_max + lon_step, lon_step))

    @classmethod
    def from_degrees(cls, bounds: Bounds, step: float, end_margin: float = 1.0) -> GridSpec:
        """Degree grid; ``end_margin`` steps are added past the upper bound before counting.

        1.0 is the rule of the merged cubes, 0.5 the rule of the binned ones; the
        two can differ by one row.
        """
        lon_min, lon_max, lat_min, lat_max = bounds
        extra = step * end_margin
        return cls(lat_min, step, _axis_length(lat_min, lat_max + extra, step),
                   lon_min, step, _axis_length(lon_min, lon_max + extra, step))

    def crop(self, bounds: Bounds) -> GridSpec:
        """The cells whose centres lie inside ``bounds``, all four sides included."""
        lon_min, lon_max, lat_min, lat_max = bounds
        rows = np.flatnonzero((self.lats() >= lat_min) & (self.lats() <= lat_max))
        cols = np.flatnonzero((self.lons() >= lon_min) & (self.lons() <= lon_max))
        return replace(self,
                       i0=self.i0 + (int(rows[0]) if rows.size else 0), nlat=int(rows.size),
                       j0=self.j0 + (int(cols[0]) if cols.size else 0), nlon=int(cols.size))

    # -- driver-side facts ----------------------------------------------------
    @property
    def size(self) -> int:
        return self.nlat * self.nlon

    @property
    def cell_deg(self) -> float:
        """Mean of the two steps, the unit of cell-counted search radii."""
        return (self.lat_step + self.lon_step) / 2

    def lats(self) -> np.ndarray:
        return self.lat0 + (np.arange(self.nlat) + self.i0) * self.lat_step

    def lons(self) -> np.ndarray:
        return self.lon0 + (np.arange(self.nlon) + self.j0) * self.lon_step

    @property
    def lat_edge0(self) -> float:
        return self.lat0 + (self.i0 - 0.5) * self.lat_step

    @property
    def lon_edge0(self) -> float:
        return self.lon0 + (self.j0 - 0.5) * self.lon_step

    def signature(self) -> tuple:
        """Shape and corner coordinates: equal signatures may be merged cell by cell."""
        lats, lons = self.lats(), self.lons()
        return (self.nlat, self.nlon, round(float(lats[0]), 6), round(float(lats[-1]), 6),
                round(float(lons[0]), 6), round(float(lons[-1]), 6))

    # -- column expressions ---------------------------------------------------
    def lat_of(self, i: Column) -> Column:
        return F.lit(float(self.lat0)) + (i + self.i0) * F.lit(float(self.lat_step))

    def lon_of(self, j: Column) -> Column:
        return F.lit(float(self.lon0)) + (j + self.j0) * F.lit(float(self.lon_step))

    def with_coordinates(self, df: DataFrame, i: str = "i", j: str = "j") -> DataFrame:
        return df.withColumns({"lat": self.lat_of(F.col(i)), "lon": self.lon_of(F.col(j))})

    def lat_edge(self, k: Column) -> Column:
        """Edge ``k`` of ``nlat + 1``: midpoints inside, half a step outside the border cells."""
        return F.lit(float(self.lat_edge0)) + k * F.lit(float(self.lat_step))

    def lon_edge(self, k: Column) -> Column:
        return F.lit(float(self.lon_edge0)) + k * F.lit(float(self.lon_step))

    def row_index(self, lat: Column) -> Column:
        return _bin_index(lat, self.lat_edge0, self.lat_step, self.nlat)

    def col_index(self, lon: Column) -> Column:
        return _bin_index(lon, self.lon_edge0, self.lon_step, self.nlon)

    def nearest_row(self, lat: Column) -> Column:
        return _nearest_index(lat, self.lat_of, self.lat0 + self.i0 * self.lat_step, self.lat_step, self.nlat)

    def nearest_col(self, lon: Column) -> Column:
        return _nearest_index(lon, self.lon_of, self.lon0 + self.j0 * self.lon_step, self.lon_step, self.nlon)

    def contains(self, lat: Column, lon: Column) -> Column:
        """Point within the outer edges of the grid."""
        return (lat.between(float(self.lat_edge0), self.lat_edge0 + self.nlat * self.lat_step)
                & lon.between(self.lon_edge0, self.lon_edge0 + self.nlon * self.lon_step))

    def with_cell(self, df: DataFrame, lat: str = "lat", lon: str = "lon") -> DataFrame:
        """Rows inside the grid with their cell ``i, j``.

        The range test stands alone in front, so the index needs no null branches and
        the generated code stays small enough to be compiled by the JVM.
        """
        inside = df.where(self.contains(F.col(lat), F.col(lon)))
        return inside.withColumns({
            "i": _bin_inside(F.col(lat), self.lat_edge0, self.lat_step, self.nlat),
            "j": _bin_inside(F.col(lon), self.lon_edge0, self.lon_step, self.nlon)})

    # -- tables ---------------------------------------------------------------
    def cells(self, spark: SparkSession) -> DataFrame:
        """All cells, generated in parallel from one range: ``i, j, lat, lon``."""
        flat = spark.range(self.size)
        return self.with_coordinates(flat.select(
            F.expr(f"cast(id div {max(self.nlon, 1)} as int)").alias("i"),
            F.expr(f"cast(id % {max(self.nlon, 1)} as int)").alias("j")))


def _bin_inside(x: Column, edge0: float, step: float, n: int) -> Column:
    """Left-closed bin of ``x`` known to lie between the outer edges, the last edge included.

    The quotient may be off by one in the last bit, so it is corrected against the
    edges themselves.
    """
    e0, st = F.lit(float(edge0)), F.lit(float(step))
    guess = F.floor((x - e0) / st)
    over, under = x >= e0 + (guess + 1) * st, x < e0 + guess * st
    return F.least(guess + over.cast("int") - under.cast("int"), F.lit(n - 1).cast("long")).cast("int")


def _bin_index(x: Column, edge0: float, step: float, n: int) -> Column:
    """``_bin_inside`` with null for points outside."""
    e0, last = F.lit(float(edge0)), F.lit(float(edge0)) + F.lit(n) * F.lit(float(step))
    return F.when(x.between(e0, last), _bin_inside(x, edge0, step, n))


def _nearest_index(x: Column, centre, first: float, step: float, n: int) -> Column:
    """Index of the closest centre; the lower index wins a tie, ends are clamped."""
    low = F.floor((x - F.lit(float(first))) / F.lit(float(step))).cast("int")
    low = F.greatest(F.lit(0), F.least(low, F.lit(n - 1)))
    high = F.least(low + 1, F.lit(n - 1))
    return F.when(F.abs(centre(high) - x) < F.abs(centre(low) - x), high).otherwise(low)
