"""Quality control of swath pixels: pure predicates, so they reach the Parquet scan."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skygrid.functions.geo import in_box, is_finite

# Fewest pixels worth gridding, and raw codes a reprojection ignores.
MIN_POINTS = 10
ZERO_FILL_CODES = (0.0, -28672.0)


def bbox_filter(pixels: DataFrame, bounds) -> DataFrame:
    return pixels.where(in_box(F.col("lat"), F.col("lon"), bounds))


def qa_filter(pixels: DataFrame, threshold: float = 0.5, qa: str = "qa") -> DataFrame:
    """Keep ``qa >= threshold``; a missing qa fails, a missing qa column lets all pass."""
    return pixels.where(F.col(qa) >= threshold) if qa in pixels.columns else pixels


def flag_filter(pixels: DataFrame, good: int = 0, flag: str = "flag") -> DataFrame:
    return pixels.where(F.col(flag) == good) if flag in pixels.columns else pixels


def cloud_filter(pixels: DataFrame, maximum: float, cloud: str = "cloud") -> DataFrame:
    return pixels.where((F.col(cloud) <= maximum) & is_finite(F.col(cloud))) if cloud in pixels.columns else pixels


def positive_filter(pixels: DataFrame, value: str = "value") -> DataFrame:
    return pixels.where(F.col(value) > 0)


def cap_filter(pixels: DataFrame, maximum: float | None, value: str = "value") -> DataFrame:
    """``0 < value <= maximum``, the rule for optical-depth bands."""
    kept = F.col(value) > 0
    return pixels.where(kept if maximum is None else kept & (F.col(value) <= maximum))


def finite_filter(pixels: DataFrame, columns=("value", "lat", "lon")) -> DataFrame:
    for name in columns:
        pixels = pixels.where(is_finite(F.col(name)))
    return pixels


def drop_zero_fill(pixels: DataFrame, value: str = "value") -> DataFrame:
    """Exact zeros and the fill code do not take part in a reprojection."""
    return pixels.where(F.col(value).isNotNull() & ~F.col(value).isin(*ZERO_FILL_CODES))


def min_points(pixels: DataFrame, keys=("granule_id",), minimum: int = MIN_POINTS) -> DataFrame:
    """Drop whole granules (or bands) with fewer than ``minimum`` rows.

    The count is combined map-side and comes back as a semi-join, so a granule is
    never gathered in one task.
    """
    kept = pixels.groupBy(*keys).agg(F.count("*").alias("_n")).where(F.col("_n") >= minimum).select(*keys)
    return pixels.join(kept, list(keys), "left_semi")


def require_data_in_box(pixels: DataFrame, bounds, key: str = "granule_id") -> DataFrame:
    """Keep the granules that have at least one valid pixel inside ``bounds``."""
    hit = pixels.where(in_box(F.col("lat"), F.col("lon"), bounds) & is_finite(F.col("value")))
    return pixels.join(hit.select(key).distinct(), key, "left_semi")


def swath_qc(pixels: DataFrame, *, bounds=None, positive: bool = True, good_flag: int | None = 0,
             cloud_max: float | None = None, minimum: int = MIN_POINTS) -> DataFrame:
    """The full chain for one source: finite, positive, flag, cloud, box, enough pixels."""
    kept = finite_filter(pixels)
    if positive:
        kept = positive_filter(kept)
    if good_flag is not None:
        kept = flag_filter(kept, good_flag)
    if cloud_max is not None:
        kept = cloud_filter(kept, cloud_max)
    if bounds is not None:
        kept = bbox_filter(kept, bounds)
    return min_points(kept, minimum=minimum)
