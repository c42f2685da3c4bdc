"""Readers that end in the ``pixels`` layout, one row per pixel."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skygrid.functions.geo import decode, finite
from skygrid.functions.lookup import AEROSOL_WAVELENGTHS_NM, first_present


def resolve_variable(df: DataFrame, wanted: Sequence[str], target: str = "value", fallback_to_first: bool = False,
                     ignore: Sequence[str] = ()) -> DataFrame | None:
    """The first wanted column as ``target``; None when a source has none of them."""
    pool = [c for c in df.columns if c not in ignore]
    name = first_present(wanted, pool, fallback_to_first)
    return None if name is None else df.withColumnRenamed(name, target)


def resolve_coords(df: DataFrame, aliases: Mapping[str, Sequence[str]]) -> DataFrame:
    """Rename the first matching alias of every coordinate; a missing one is an error."""
    for target, names in aliases.items():
        name = first_present(names, df.columns)
        if name is None:
            raise ValueError(f"no column for {target}; tried {list(names)}")
        df = df.withColumnRenamed(name, target)
    return df


def explode_grid(dense: DataFrame, arrays: Sequence[str] = ("lat", "lon", "value")) -> DataFrame:
    """2-D arrays per granule to pixels ``row_idx, col_idx``; the arrays are zipped, not joined.

    Shapes may differ: the result covers the common rows and columns.
    """
    rows = F.least(*[F.size(a) for a in arrays])
    out = dense.select(*[c for c in dense.columns if c not in arrays],
                       F.posexplode(F.slice(F.arrays_zip(*arrays), F.lit(1), rows)).alias("row_idx", "_row"))
    cols = F.least(*[F.size(F.col(f"_row.{a}")) for a in arrays])
    cells = F.slice(F.arrays_zip(*[F.col(f"_row.{a}").alias(a) for a in arrays]), F.lit(1), cols)
    out = out.select(*[c for c in out.columns if c != "_row"], F.posexplode(cells).alias("col_idx", "_cell"))
    return out.select(*[c for c in out.columns if c != "_cell"],
                      *[finite(F.col(f"_cell.{a}")).alias(a) for a in arrays])


def swath_s5p(pixels: DataFrame, hub: str, product: str, variable: str = "value") -> DataFrame | None:
    """Pixels of one product; None when the variable is missing, qa 1 when there is none."""
    if variable not in pixels.columns:
        return None
    picked = pixels.where((F.col("hub") == hub) & (F.col("product") == product)).withColumnRenamed(variable, "value")
    return picked if "qa" in picked.columns else picked.withColumn("qa", F.lit(1.0))


def swath_gems(data: DataFrame, geo: DataFrame, keys=("granule_id", "row_idx", "col_idx")) -> DataFrame:
    """Values and positions kept in two tables, matched by their place in the swath."""
    return data.join(geo, list(keys))


def swath_modis(pixels: DataFrame, scale: Column | float = 0.001, fill: Column | int = -9999) -> DataFrame:
    """Scaled integers decoded to values."""
    return pixels.withColumn("value", decode(F.col("raw"), scale, fill))


def explode_bands(pixels: DataFrame, bands: str = "bands", wavelengths: Sequence[int] = AEROSOL_WAVELENGTHS_NM) -> DataFrame:
    """One row per wavelength; a pixel with another number of bands gives nothing."""
    names = F.array(*[F.lit(w) for w in wavelengths])
    return (pixels.where(F.size(bands) == len(wavelengths))
            .select(*[c for c in pixels.columns if c != bands], F.posexplode(bands).alias("_pos", "value"))
            .withColumn("band_nm", F.element_at(names, F.col("_pos") + 1)).drop("_pos"))


def first_layer(pixels: DataFrame, layer: str = "layer_idx") -> DataFrame:
    return pixels.where(F.col(layer) == 0)


def align_shapes(*arrays: DataFrame, keys=("granule_id", "row_idx", "col_idx")) -> DataFrame:
    """Crop to the common shape: only places present in every array remain."""
    first, *rest = arrays
    for other in rest:
        first = first.join(other, list(keys))
    return first


def common_shape(pixels: DataFrame, key: str = "granule_id") -> DataFrame:
    """Crop all granules to the smallest number of rows and columns among them."""
    sizes = pixels.groupBy(key).agg(F.max("row_idx").alias("r"), F.max("col_idx").alias("c"))
    last = sizes.agg(F.struct(F.min("r").alias("r"), F.min("c").alias("c"))).scalar()
    return (pixels.withColumn("_last", last)
            .where((F.col("row_idx") <= F.col("_last.r")) & (F.col("col_idx") <= F.col("_last.c"))).drop("_last"))
