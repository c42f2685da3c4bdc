"""Arriving granules: ingest once, grid, running daily means, rebuild of late days."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType

from skygrid.functions.geo import cell_weight, finite, is_finite
from skygrid.functions.numbers import round_even
from skygrid.operators.accumulate import weighted_stats
from skygrid.operators.coverage import coverage_total
from skygrid.operators.region import region_cells, restrict_to_region
from skygrid.operators.regrid import supersample_regrid
from skygrid.plans.cellmaps import WORD, WORD_BITS
from skygrid.plans.dimension import hint_if_bounded
from skygrid.plans.grid import GridSpec
from skygrid.sources.tables import rebuild_partitions


def read_stream(spark: SparkSession, path: str, schema, files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def _read_or_none(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame:
    """A table that may not exist before the first batch."""
    try:
        return spark.read.schema(schema).option("basePath", path).parquet(path)
    except Exception as missing:  # noqa: BLE001
        if "PATH_NOT_FOUND" not in str(missing):
            raise
        return spark.createDataFrame([], schema)


LEDGER = "granule_id long, status string, n_pixels long, processed_at timestamp, batch_id long"


def _stored(spark: SparkSession, path: str, schema: StructType, batches: list[int]) -> DataFrame:
    """Rows that the named batches have written; other batch partitions are not read."""
    fields = StructType([*schema.fields, StructField("batch_id", LongType())])
    return _read_or_none(spark, path, fields).where(F.col("batch_id").isin(batches)).drop("batch_id")


def ingest_granules(stream: DataFrame, sink: str, ledger: str, checkpoint: str,
                    transform: Callable[[DataFrame], DataFrame] | None = None, expected: str | None = None) -> StreamingQuery:
    """Keep each pixel of each granule once, recording granules in the ledger.

    A granule may arrive over several batches and files may come twice: a batch keeps the pixels that no earlier batch
    of the same granules has. It writes its own ``batch_id`` partition once, everything else is read from there, and a
    batch that is re-run after a lost executor or driver replaces it with the same rows.

    With ``transform`` the pixels go to ``<sink>-pixels``, and the granules a batch has added to are transformed whole into
    ``sink``; ``latest`` picks the newest result of each. ``expected`` names a column with the number of pixels of the
    granule: until they are all there the granule is recorded as ``partial`` and not transformed.
    """
    pixels_at = f"{sink}-pixels" if transform else sink

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        touched = batch.select("granule_id").distinct()
        before = (_read_or_none(spark, ledger, LEDGER).where(F.col("batch_id") < batch_id)
                  .join(touched, "granule_id", "left_semi").select("batch_id").distinct())
        # A batch number each, of the batches that hold parts of the same granules.
        batches = [r[0] for r in before.collect()]
        seen = _stored(spark, pixels_at, batch.schema, batches).select("granule_id", "pixel_id")
        fresh = batch.dropDuplicates(["granule_id", "pixel_id"]).join(seen, ["granule_id", "pixel_id"], "left_anti").select(batch.columns)
        fresh.write.mode("overwrite").parquet(f"{pixels_at}/batch_id={batch_id}")
        new = spark.read.schema(batch.schema).parquet(f"{pixels_at}/batch_id={batch_id}")
        grown = new.select("granule_id").distinct()
        whole = new.unionByName(_stored(spark, pixels_at, batch.schema, batches).join(grown, "granule_id", "left_semi"))
        n, valid = F.count("*"), F.count(finite(F.col("value")))
        short = n < F.max(expected) if expected else F.lit(False)
        status = whole.groupBy("granule_id").agg(
            F.when(short, "partial").when(valid > 0, "ok").otherwise("empty").alias("status"),
            n.alias("n_pixels"), F.current_timestamp().alias("processed_at"))
        if transform:
            ready = whole.join(status.where("status <> 'partial'").select("granule_id"), "granule_id", "left_semi") if expected else whole
            transform(ready).write.mode("overwrite").parquet(f"{sink}/batch_id={batch_id}")
        status.write.mode("overwrite").parquet(f"{ledger}/batch_id={batch_id}")

    return (stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def current_status(spark: SparkSession, ledger: str) -> DataFrame:
    """The newest ledger line of each granule."""
    lines = spark.read.schema(LEDGER).option("basePath", ledger).parquet(ledger)
    return lines.groupBy("granule_id").agg(F.max_by("status", "batch_id").alias("status"), F.max_by("n_pixels", "batch_id").alias("n_pixels"),
                                           F.max("batch_id").alias("batch_id"))


def latest(spark: SparkSession, sink: str, ledger: str) -> DataFrame:
    """Transformed rows of each granule's newest batch; results of a granule's earlier parts are left out."""
    return spark.read.parquet(sink).join(current_status(spark, ledger).select("granule_id", "batch_id"), ["granule_id", "batch_id"], "left_semi")


def stream_grid(stream: DataFrame, grid: GridSpec, sink: str, ledger: str, checkpoint: str, k: int = 4,
                expected: str | None = None) -> StreamingQuery:
    """Grid every arriving granule by supersampling, again when more of it arrives; read the result with ``latest``."""
    return ingest_granules(stream, sink, ledger, checkpoint, lambda pixels: supersample_regrid(pixels, grid, k), expected)


def daily_mean(stream: DataFrame, grid: GridSpec, delay: str = "2 days") -> DataFrame:
    """Closed days only: qa-weighted mean, count and std per day and cell, in event time.

    The state is one row per open day and cell; late pixels beyond ``delay`` are left
    to ``reprocess_window``.
    """
    mean, count, std = weighted_stats(F.col("value"), F.col("weight"))
    binned = (stream.withColumns({"i": grid.row_index(F.col("lat")), "j": grid.col_index(F.col("lon")),
                                  "weight": F.col("qa")})
              .where(F.col("i").isNotNull() & F.col("j").isNotNull())
              .withWatermark("obs_time", delay))
    return (binned.groupBy(F.window("obs_time", "1 day").alias("day"), "i", "j")
            .agg(mean.alias("value"), count.alias("count"), std.alias("std"))
            .select(F.to_date("day.start").alias("obs_date"), "i", "j", "value", "count", "std"))


def write_closed_days(means: DataFrame, sink: str, checkpoint: str) -> StreamingQuery:
    return (means.writeStream.outputMode("append").format("parquet").option("path", sink)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def stream_coverage(stream: DataFrame, grid: GridSpec, region=None, weight: str = "count", vertices: DataFrame | None = None,
                    delay: str = "2 days", slice_key: str = "granule_id") -> DataFrame:
    """Closed days only: valid and total weight of a region, coverage and the number of granules, in one streaming query.

    A first windowed aggregate holds, for each open day, the observed cells as words of 64 columns and the granules as marks; when the
    day closes, a second one on ``window_time`` adds up the weights and counts the marks. A granule without any valid pixel
    still counts, and so does its day. ``region`` is a box, or a zone with its outlines; without one, the whole grid.
    """
    if region is None:
        region = (float("-inf"), float("inf"), float("-inf"), float("inf"))
    total = coverage_total(grid, region, weight, stream.sparkSession, vertices)
    placed = stream.withWatermark("obs_time", delay).withColumns(
        {"i": grid.row_index(F.col("lat")), "j": grid.col_index(F.col("lon"))})
    mask = region_cells(grid, region, stream.sparkSession, vertices).select("i", "j", F.lit(True).alias("_in"))
    placed = placed.join(hint_if_bounded(mask, grid.size), ["i", "j"], "left")
    seen = F.col("_in") & is_finite(F.col("value")) & (F.col("qa") > 0)
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("j").bitwiseAND(WORD - 1))

    def mark(granule: Column, row: Column, word: Column, bits: Column) -> Column:
        return F.struct(granule.alias("granule"), row.alias("i"), word.alias("w"), bits.alias("bits"))

    cell = mark(F.lit(None).cast("string"), F.col("i"), F.shiftright("j", WORD_BITS), bit)
    granule = mark(F.col(slice_key).cast("string"), F.lit(None).cast("int"), F.lit(None).cast("int"), F.lit(0).cast("long"))
    marks = placed.select("obs_time", F.explode(F.when(seen, F.array(cell, granule)).otherwise(F.array(granule))).alias("_m"))
    days = marks.groupBy(F.window("obs_time", "1 day").alias("day"), "_m.granule", "_m.i", "_m.w").agg(F.bit_or("_m.bits").alias("bits"))
    row_weight = cell_weight(grid.lat_of(F.col("i")), weight)
    found = days.groupBy(F.window(F.window_time("day"), "1 day").alias("day")).agg(
        F.coalesce(F.sum(row_weight * F.bit_count("bits")), F.lit(0.0)).alias("valid"), F.count("granule").alias("n_slices"))
    return found.select(F.to_date("day.start").alias("obs_date"), "valid", total.alias("total"),
                        round_even(F.try_divide(F.col("valid"), total), 5).alias("coverage"), "n_slices")


def closed_day_coverage(closed: DataFrame, grid: GridSpec, region=None, weight: str = "count",
                        vertices: DataFrame | None = None) -> DataFrame:
    """Share of the grid, or of a region, with a value, per closed day; cells by number or by area."""
    if region is None:
        region = (float("-inf"), float("inf"), float("-inf"), float("inf"))
    total = coverage_total(grid, region, weight, closed.sparkSession, vertices)
    inside = restrict_to_region(closed.where(finite(F.col("value")).isNotNull()), grid, region, vertices)
    w = cell_weight(grid.lat_of(F.col("i")), weight)
    seen = inside.groupBy("obs_date").agg(F.sum(w).alias("valid"))
    return (closed.select("obs_date").distinct().join(seen, "obs_date", "left")
            .select("obs_date", F.coalesce("valid", F.lit(0.0)).alias("valid"))
            .withColumn("coverage", round_even(F.try_divide(F.col("valid"), total), 5)))


def reprocess_window(rebuilt: DataFrame, sink: str, day: str = "obs_date") -> None:
    """Replace the days present in ``rebuilt`` and leave all others alone."""
    rebuild_partitions(rebuilt, sink, (day,))
