"""Distances, cell weights, sinusoidal tiles and raw-value decoding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from skygrid.plans import grid as _grid

# Fixed values of the sinusoidal tile system: sphere radius (m), pixel size (m),
# pixels per tile side, origin of tile h00v00 (m) and the tile assumed when none is named.
SPHERE_RADIUS = 6371007.181
PIXEL_SIZE = 926.625433056
TILE_PIXELS = 1200
ORIGIN_X = -20015109.354
ORIGIN_Y = 10007554.677
DEFAULT_TILE = (29, 6)

# Tile patterns, tried in this order.
TILE_PATTERNS = (
    r"\.h(\d{2})v(\d{2})\.",
    r"h(\d{2})v(\d{2})",
    r"_h(\d{2})v(\d{2})_",
    r"h(\d{2})v(\d{2})\.",
)


def is_finite(x: Column) -> Column:
    """False for null, NaN and infinities (Spark orders NaN above every number)."""
    return F.abs(x) < F.lit(float("inf"))


def finite(x: Column) -> Column:
    """NaN and infinities become null, so that aggregates and comparisons skip them."""
    return F.when(is_finite(x), x)


def km_to_deg_lat(km: Column) -> Column:
    return km / F.lit(_grid.KM_PER_DEG_LAT)


def km_to_deg_lon(km: Column, latitude: Column) -> Column:
    """Longitude degrees spanned by ``km`` at a latitude, 0 next to the poles."""
    per_degree = F.lit(_grid.EARTH_RADIUS_KM) * F.cos(F.radians(latitude)) * 2 * F.lit(3.141592653589793) / 360
    return F.when(F.abs(latitude) > _grid.POLAR_LIMIT_DEG, F.lit(0.0)).otherwise(km / per_degree)


def deg_distance(lat1: Column, lon1: Column, lat2: Column, lon2: Column, lon_scale: Column | float = 1.0) -> Column:
    """Plain distance in degrees; ``lon_scale`` shrinks the longitude difference."""
    scale = lon_scale if isinstance(lon_scale, Column) else F.lit(float(lon_scale))
    dy, dx = lat1 - lat2, (lon1 - lon2) * scale
    return F.sqrt(dy * dy + dx * dx)


def cell_weight(lat: Column, mode: str = "count") -> Column:
    if mode == "count":
        return F.lit(1.0)
    if mode == "area":
        return F.cos(F.radians(lat))
    raise ValueError("weight must be 'count' or 'area'")


def in_box(lat: Column, lon: Column, bounds) -> Column:
    """Inclusive on all four sides; bounds are (lon_min, lon_max, lat_min, lat_max)."""
    lon_min, lon_max, lat_min, lat_max = (float(b) for b in bounds)
    return lon.between(lon_min, lon_max) & lat.between(lat_min, lat_max)


def tile_hv(name: Column) -> tuple[Column, Column]:
    """Horizontal and vertical tile number in a file name."""
    def number(group: int) -> Column:
        found = [F.nullif(F.regexp_extract(name, p, group), F.lit("")).cast("int") for p in TILE_PATTERNS]
        return F.coalesce(*found, F.lit(DEFAULT_TILE[group - 1]))
    return number(1), number(2)


def sinusoidal_to_lonlat(h: Column, v: Column, row: Column, col: Column,
                         rows: int = TILE_PIXELS, cols: int = TILE_PIXELS) -> tuple[Column, Column]:
    """(lat, lon) of a tile pixel; rows and columns span the tile with both ends included."""
    side = TILE_PIXELS * PIXEL_SIZE
    x = F.lit(ORIGIN_X) + h * F.lit(side) + col * F.lit(side / max(cols - 1, 1))
    y = F.lit(ORIGIN_Y) - v * F.lit(side) - row * F.lit(side / max(rows - 1, 1))
    angle = y / F.lit(SPHERE_RADIUS)
    lon = F.degrees(x / (F.lit(SPHERE_RADIUS) * F.cos(angle)))
    lat = F.degrees(angle)
    return (F.greatest(F.lit(-90.0), F.least(lat, F.lit(90.0))),
            F.greatest(F.lit(-180.0), F.least(lon, F.lit(180.0))))


def decode(raw: Column, scale: Column | float = 0.001, fill: Column | int = -9999) -> Column:
    """Scaled integer to value; the fill code and negative raw values become null."""
    scale = scale if isinstance(scale, Column) else F.lit(float(scale))
    fill = fill if isinstance(fill, Column) else F.lit(fill)
    return F.when((raw != fill) & (raw >= 0), raw * scale)


def readable_size(length: Column) -> Column:
    """Byte count as text in B, KB, MB or GB; halves go to the even digit."""
    def unit(power: int, label: str) -> Column:
        return F.format_string(f"%.2f {label}", F.bround(length / F.lit(float(1024 ** power)), 2))
    return (F.when(length < 1024, F.format_string("%d B", length))
            .when(length < 1024 ** 2, unit(1, "KB"))
            .when(length < 1024 ** 3, unit(2, "MB"))
            .otherwise(unit(3, "GB")))
