"""Shared wording of the queries and their check SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skygrid.plans.grid import GridSpec


def r6(x: Column | str) -> Column:
    """Six decimals by the same arithmetic in both engines.

    The cut is not at a half, where sums added in another order would fall to either side.
    """
    x = F.col(x) if isinstance(x, str) else x
    return F.floor(x * F.lit(1e6) + F.lit(0.3137)) / F.lit(1e6)


def R6(expr: str) -> str:
    return f"floor(({expr}) * 1e6 + 0.3137e0) / 1e6"


def cents(x: str) -> Column:
    """Total of two-decimal amounts as a whole number of hundredths: exact in any order."""
    return F.sum(F.rint(F.col(x) * F.lit(100.0))).cast("long")


def CENTS(expr: str) -> str:
    return f"cast(sum(round_even({expr} * 100e0, 0)) as bigint)"


def ts(x: Column | str) -> Column:
    return F.date_format(x, "yyyy-MM-dd HH:mm:ss")


def TS(expr: str) -> str:
    return f"strftime({expr}, '%Y-%m-%d %H:%M:%S')"


def ds(x: Column | str) -> Column:
    return F.date_format(x, "yyyy-MM-dd")


def DS(expr: str) -> str:
    return f"strftime({expr}, '%Y-%m-%d')"


def dbl(x: float) -> str:
    """A double literal that the check engine does not read as a decimal."""
    return f"({float(x)!r}e0)" if "e" not in repr(float(x)) else f"({float(x)!r})"


def cells_cte(name: str, g: GridSpec) -> str:
    return (f"{name} as (select cast(a.i as int) as i, cast(b.j as int) as j, "
            f"{dbl(g.lat0)} + (a.i + {g.i0}) * {dbl(g.lat_step)} as lat, "
            f"{dbl(g.lon0)} + (b.j + {g.j0}) * {dbl(g.lon_step)} as lon "
            f"from range({g.nlat}) a(i), range({g.nlon}) b(j))")


def edges_cte(name: str, edge0: float, step: float, n: int) -> str:
    """Bins of one axis with both edges; the last one includes its upper edge."""
    return (f"{name} as (select cast(k as int) as k, {dbl(edge0)} + k * {dbl(step)} as lo, "
            f"{dbl(edge0)} + (k + 1) * {dbl(step)} as hi, k = {n - 1} as last from range({n}) t(k))")


def grid_edges_ctes(g: GridSpec, lat: str = "lat_bins", lon: str = "lon_bins") -> str:
    return (edges_cte(lat, g.lat_edge0, g.lat_step, g.nlat) + ",\n"
            + edges_cte(lon, g.lon_edge0, g.lon_step, g.nlon))


def in_bin(x: str, b: str) -> str:
    return f"({x} >= {b}.lo and ({x} < {b}.hi or ({b}.last and {x} = {b}.hi)))"


def cells_out(df: DataFrame, *extra: str, value: str = "value") -> DataFrame:
    return df.select("granule_id", "i", "j", r6(value).alias("value"), *extra)
