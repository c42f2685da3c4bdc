"""Cubes joined along time, and the set operations around them."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skygrid.functions.time import EPOCH, gems_time, in_date_range, l3_date
from skygrid.operators.coverage import on_grid
from skygrid.plans.grid import GridSpec


def assign_time(df: DataFrame, name: str = "name", time: str = "time") -> DataFrame:
    """A real time stays; otherwise the date in the file name; otherwise 1970-01-01."""
    named = l3_date(F.col(name)).cast("timestamp")
    own = F.col(time) if time in df.columns else F.lit(None).cast("timestamp")
    return df.withColumn(time, F.coalesce(own, named, F.lit(EPOCH)))


def discover_l3(files: DataFrame, start, end, name: str = "name") -> DataFrame:
    """Files whose name date lies in [start, end]; undated ones are kept."""
    dated = l3_date(F.col(name))
    inside = dated.between(F.lit(start).cast("date"), F.lit(end).cast("date"))
    return files.where(F.coalesce(inside, F.lit(True)))


def merge_cubes(cubes: Sequence[DataFrame], start, end, *, hub: str, product: str, level: str = "L2",
                grids: Sequence[GridSpec] = (), slice_key: str | None = None) -> DataFrame:
    """All slices in [start, end of day], nothing de-duplicated, with provenance columns.

    Row order is a matter of the sink (``sort_by_time``). Cubes on different grids are refused: those whose rows name
    their grid (``grid_id``) by their rows, and with ``grids``, one a cube, by signature and by the position of every row that has one, in
    the pass that reads it. Without either nothing can be told.
    """
    if len({g.signature() for g in grids}) > 1:
        raise ValueError("cubes are on different grids")
    if grids:
        cubes = [on_grid(cube, grid) for cube, grid in zip(cubes, grids, strict=True)]
    if all("grid_id" in c.columns for c in cubes):
        named = reduce(lambda a, b: a.union(b), [c.where(in_date_range(F.col("time"), start, end)).select("grid_id") for c in cubes])
        if len(found := named.where("grid_id is not null").distinct().limit(2).collect()) > 1:
            raise ValueError(f"cubes are on different grids: {sorted(r[0] for r in found)}")
    union = reduce(lambda a, b: a.unionByName(b), cubes)
    merged = union.where(in_date_range(F.col("time"), start, end)).withColumns({
        "hub": F.lit(hub), "product": F.lit(product), "level": F.lit(level),
        "time_range": F.lit(f"{start}..{end}")})
    if slice_key is not None:
        sources = merged.select(slice_key, "time").distinct().agg(F.count("*")).scalar()
        merged = merged.withColumn("n_sources", sources)
    return merged


def merge_by_name_time(cube: DataFrame, start, end, name: str = "name") -> DataFrame:
    """Files picked by the stamp in their names, values narrowed to float for the sink."""
    stamped = cube.withColumn("time", gems_time(F.col(name)))
    return stamped.where(in_date_range(F.col("time"), start, end)).withColumn("value", F.col("value").cast("float"))


def sort_by_time(df: DataFrame, *more: str, time: str = "time") -> DataFrame:
    return df.orderBy(time, *more)


def union_tables(frames: Sequence[DataFrame]) -> DataFrame:
    """Providers under one schema; columns only one of them has stay null for the others."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def missing_keys(wanted: DataFrame, present: DataFrame, keys: Sequence[str]) -> DataFrame:
    return wanted.join(present, list(keys), "left_anti")


def affected_days(cube: DataFrame, last_day, days: int = 30, time: str = "time") -> DataFrame:
    """Rows of the trailing window that a re-run rebuilds."""
    first = last_day - timedelta(days=days)
    return cube.where(F.to_date(F.col(time)).between(F.lit(first), F.lit(last_day)))
