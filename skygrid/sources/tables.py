"""Readers and writers of the engine's own tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skygrid.functions.time import granule_time, in_date_range

# Fixed value: text encodings of provider files, tried in this order.
ENCODINGS = ("utf-8", "big5", "cp950", "gb2312", "gbk", "latin1")

REPLACEMENT = "\N{REPLACEMENT CHARACTER}"

CUBE_PARTITIONS = ("hub", "level", "region", "product", "yyyy", "mm")


def is_real_file(path: Column) -> Column:
    """False for ``._*`` sidecar files."""
    return ~F.startswith(F.element_at(F.split(path, "/"), -1), F.lit("._"))


def month_filter(start, end) -> Column:
    """Range over the ``yyyy``/``mm`` partition columns, so other months are never listed."""
    key = F.concat(F.col("yyyy"), F.col("mm"))
    return key.between(F.date_format(F.lit(start).cast("timestamp"), "yyyyMM"),
                       F.date_format(F.lit(end).cast("timestamp"), "yyyyMM"))


# Columns of a stored cube besides its partition columns.
CUBE_SCHEMA = ("time timestamp, slice_id string, i int, j int, lat double, lon double, value double, count double, std double, "
               "units string, processing_method string, description string, source string, resolution string, grid_id string, "
               "hub string, level string, region string, product string, yyyy string, mm string")


def _cube_files(spark: SparkSession, path: str, schema: str, skip_damaged: bool) -> DataFrame:
    return (spark.read.schema(schema).option("ignoreCorruptFiles", str(skip_damaged).lower())
            .option("pathGlobFilter", "[!.]*.parquet").parquet(path))


def scan_cube(spark: SparkSession, path: str, product: str, start=None, end=None, layout: str = "year_month", *,
              hub: str | None = None, level: str | None = None, region: str | None = None,
              schema: str = CUBE_SCHEMA, skip_damaged: bool = False) -> DataFrame:
    """Cube rows of one product, and of one hub, level and region where given; other partitions are pruned.

    A ``flat`` layout has no month partitions. The schema is fixed, so no file is opened to find it. A damaged file
    stops the scan unless ``skip_damaged`` is set; ``unread_files`` names those that were left out.
    """
    cube = _cube_files(spark, path, schema, skip_damaged).where(F.col("product") == product)
    for name, wanted in (("hub", hub), ("level", level), ("region", region)):
        if wanted is not None:
            cube = cube.where(F.col(name) == wanted)
    if layout == "year_month" and start is not None and end is not None:
        cube = cube.withColumn("mm", F.lpad("mm", 2, "0")).where(month_filter(start, end))
    return cube


def unread_files(spark: SparkSession, path: str, schema: str = CUBE_SCHEMA) -> DataFrame:
    """Files below ``path`` that a scan which skips damage takes no row from: path and length."""
    named = lambda c: F.regexp_replace(c, "^file:/+", "/")
    seen = _cube_files(spark, path, schema, True).select(named(F.col("_metadata.file_path")).alias("path")).distinct()
    files = file_inventory(spark, path, "[!.]*.parquet").select(named(F.col("path")).alias("path"), "length")
    return files.join(seen, "path", "left_anti")


def slices(cube: DataFrame, start, end, path: str | None = None, time: str = "time") -> DataFrame:
    """Rows whose time lies in [start, end]; a missing time is read from the file name."""
    if path is None:
        return cube.where(in_date_range(F.col(time), start, end))
    # Rows that have a time are left to the scan's own filters; only the others have their name parsed.
    timed = cube.where(F.col(time).isNotNull() & in_date_range(F.col(time), start, end))
    named = cube.where(F.col(time).isNull()).withColumn(time, granule_time(F.col(path)))
    return timed.unionByName(named.where(in_date_range(F.col(time), start, end)))


def cube_layout(cube: DataFrame, *, hub: str, product: str, level: str = "L2", region: str = "taiwan",
                units: str = "", method: str = "", description: str = "", source: str = "", resolution: str = "") -> DataFrame:
    """Cube rows with their partition columns and the attributes of the field."""
    return cube.withColumns({
        "hub": F.lit(hub), "product": F.lit(product), "level": F.lit(level), "region": F.lit(region),
        "units": F.lit(units), "processing_method": F.lit(method),
        "description": F.lit(description), "source": F.lit(source), "resolution": F.lit(resolution),
        "grid_id": F.col("grid_id") if "grid_id" in cube.columns else F.lit(None).cast("string"),
        "yyyy": F.date_format("time", "yyyy"), "mm": F.date_format("time", "MM")})


def write_cube(cube: DataFrame, path: str, mode: str = "replace") -> None:
    """Partitioned Parquet. Rows are rebalanced by output partition: small months share a
    task and make one file each, a large month is split over several tasks. Months present in ``cube`` are replaced,
    so writing one twice leaves it once; ``append`` adds to them."""
    if mode == "replace":
        rebuild_partitions(cube, path)
    else:
        (cube.hint("rebalance", *[F.col(c) for c in CUBE_PARTITIONS])
         .write.mode(mode).partitionBy(*CUBE_PARTITIONS).parquet(path))


def rebuild_partitions(cube: DataFrame, path: str, partitions: Sequence[str] = CUBE_PARTITIONS) -> None:
    """Replace exactly the partitions present in ``cube``; a repeated run gives the same files."""
    (cube.hint("rebalance", *[F.col(c) for c in partitions])
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*partitions).parquet(path))


def crop_l3(grid_cells: DataFrame, bounds) -> DataFrame:
    """Region of a global grid, in whichever order its latitudes run."""
    lon_min, lon_max, lat_min, lat_max = (float(b) for b in bounds)
    return grid_cells.where(F.col("lon").between(lon_min, lon_max) & F.col("lat").between(lat_min, lat_max))


def scan_fields(df: DataFrame, dims: Sequence[str]) -> DataFrame | None:
    """Reanalysis variable with 3 or 4 dimensions; other ranks are skipped."""
    if len(dims) not in (3, 4):
        return None
    level = next((d for d in dims if d in ("level", "pressure_level", "isobaricInhPa")), None)
    if level is None:
        return df.withColumn("level", F.lit(None).cast("int"))
    return df.withColumnRenamed(level, "level")


def read_provider_csv(spark: SparkSession, path: str, columns: dict[str, str], provider: str,
                      encoding: str | None = None) -> DataFrame | None:
    """Station file of one provider under common names; None when it cannot be read.

    Without an encoding, the known ones are tried on the file itself; undecodable
    bytes show up as the replacement character.
    """
    for candidate in ((encoding,) if encoding else ENCODINGS):
        try:
            df = spark.read.option("encoding", candidate).csv(path, header=True)
        except AnalysisException as missing:
            if "PATH_NOT_FOUND" in str(missing):
                return None
            raise
        text = F.concat_ws("", *[F.col(f"`{c}`") for c in df.columns])
        if REPLACEMENT in "".join(df.columns) or not df.where(F.contains(text, F.lit(REPLACEMENT))).isEmpty():
            continue
        return df.select(*[F.col(f"`{src}`").alias(dst) for src, dst in columns.items() if src in df.columns],
                         F.lit(provider).alias("owner"))
    return None


def write_station_csv(series: DataFrame, path: str) -> None:
    """One folder of CSV files per (variable, level)."""
    series.write.mode("overwrite").partitionBy("variable", "level_key").csv(path, header=True)


def station_file_stem(variable: Column, level: Column) -> Column:
    """``era5_sfc_<var>`` for surface fields, ``era5_pl_<var>_<level>`` for pressure levels."""
    return F.when(level.isNull(), F.concat(F.lit("era5_sfc_"), variable)).otherwise(
        F.concat(F.lit("era5_pl_"), variable, F.lit("_"), level.cast("string")))


def write_coverage_csv(coverage: DataFrame, path: str) -> None:
    coverage.write.mode("overwrite").csv(path, header=True)


def file_inventory(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """Path, time and size of every file below ``path``; contents are not read."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
             .option("pathGlobFilter", pattern).load(path))
    return files.select("path", F.col("modificationTime").alias("modified"), "length").where(is_real_file(F.col("path")))
