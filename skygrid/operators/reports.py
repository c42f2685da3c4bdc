"""Reports over file inventories."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skygrid.functions.geo import readable_size

# Fixed value: days after which a period's output is refreshed.
REFRESH_DAYS = 7


def file_expiry_report(inventory: DataFrame, cutoff: str, extensions: Sequence[str] = (),
                       group: str = "top_dir") -> DataFrame:
    """Files older than ``cutoff``: count, bytes, oldest and newest per group and in total."""
    old = inventory.where(F.col("modified") < F.lit(cutoff).cast("timestamp"))
    if extensions:
        match = F.lit(False)
        for ext in extensions:
            match = match | F.endswith(F.col("path"), F.lit(ext))
        old = old.where(match)
    order = F.struct("modified", "path")
    report = old.rollup(group).agg(F.count("*").alias("file_count"), F.sum("length").alias("total_bytes"),
                                   F.min(order).alias("_old"), F.max(order).alias("_new"))
    return report.select(
        F.coalesce(group, F.lit("total")).alias(group), "file_count", "total_bytes",
        readable_size(F.col("total_bytes")).alias("readable_size"),
        F.col("_old.path").alias("oldest_path"), F.col("_old.modified").alias("oldest"),
        F.col("_new.path").alias("newest_path"), F.col("_new.modified").alias("newest"))


def freshness_check(inventory: DataFrame, periods: DataFrame, now: str, key: str = "period") -> DataFrame:
    """Periods whose output is missing or at least a week old need a refresh."""
    last = inventory.groupBy(key).agg(F.max("modified").alias("modified"))
    limit = F.lit(now).cast("timestamp") - F.make_dt_interval(days=F.lit(REFRESH_DAYS))
    return (periods.join(last, key, "left")
            .withColumn("refresh", F.col("modified").isNull() | (F.col("modified") <= limit)))
