"""Weighted mean and spread of cells as states that merge: weight, mean, m2 (weighted squares around the mean), n."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skygrid.functions.geo import finite, is_finite
from skygrid.functions.time import in_date_range, period_start
from skygrid.sources.tables import rebuild_partitions

STATE = ("weight", "mean", "m2", "n")
PERIODS = ("day", "fortnight", "month", "season", "year")


def states_of(cells: DataFrame, keys: Sequence[str | Column], value: str = "value", weight: str = "count") -> DataFrame:
    """One state for each row: ``keys``, i, j and the state of a single value; a missing value weighs nothing."""
    w = F.when(is_finite(F.col(value)), F.coalesce(F.col(weight).cast("double"), F.lit(0.0))).otherwise(F.lit(0.0))
    return cells.select(*keys, "i", "j", w.alias("weight"), F.coalesce(finite(F.col(value)), F.lit(0.0)).alias("mean"),
                        F.lit(0.0).alias("m2"), (w > 0).cast("long").alias("n"))


def merged(states: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One state for each of ``keys``, i, j.

    The common mean comes first; then each state adds its own squares and those of its distance from that mean, so nothing large
    is subtracted from something large, whatever the size of the values. States are exchanged once: both passes read
    the same partitions, and the means are hashed where they were made. Merging merged states gives the same state.
    """
    key = [*keys, "i", "j"]
    # An array, of which no pass can prune its part: two different exchanges would take the place of one.
    placed = states.select(*key, F.array(*[F.col(c).cast("double") for c in STATE]).alias("_s")).repartition(*key)
    weight, mean, m2, n = (F.get("_s", k) for k in range(4))
    centre = placed.groupBy(*key).agg(F.sum(weight).alias("_w"), F.try_divide(F.sum(weight * mean), F.sum(weight)).alias("_c"))
    away = mean - F.col("_c")
    return (placed.join(centre.hint("shuffle_hash"), key).groupBy(*key)
            .agg(F.max("_w").alias("weight"), F.max("_c").alias("mean"), F.sum(m2 + weight * away * away).alias("m2"),
                 F.sum(n).cast("long").alias("n")))


def finished(states: DataFrame) -> DataFrame:
    """value, count and std of states; cells without any weight have no value, and a std of 0 as the streaming mean gives it."""
    rest = [c for c in states.columns if c not in STATE]
    return states.select(*rest, F.col("mean").alias("value"), F.col("n").alias("count"),
                         F.sqrt(F.coalesce(F.try_divide(F.col("m2"), F.col("weight")), F.lit(0.0))).alias("std"))


def rolled_up(days: DataFrame, periods: Sequence[str] = PERIODS, day: str = "obs_date") -> DataFrame:
    """States of several period lengths (bucket, period, i, j) out of states of days, in one exchange."""
    labels = F.array(*[F.struct(F.lit(p).alias("bucket"), period_start(F.col(day), p).alias("period")) for p in periods])
    return merged(days.withColumn("_p", F.explode(labels)).select("_p.*", "i", "j", *STATE), ("bucket", "period"))


# -- states kept as a table --------------------------------------------------------

STORED = "obs_date date, i int, j int, weight double, mean double, m2 double, n long, yyyy string, batch string"


def add_to_states(cells: DataFrame, path: str, batch: str, day: Column, value: str = "value", weight: str = "count") -> None:
    """Adds gridded granules to the day states below ``path``. A batch replaces itself when repeated, so no granule counts twice
    as long as it comes in one batch only."""
    new = merged(states_of(cells, [day.alias("obs_date")], value, weight), ("obs_date",))
    rebuild_partitions(new.withColumns({"yyyy": F.date_format("obs_date", "yyyy"), "batch": F.lit(batch)}), path, ("yyyy", "batch"))


def stored_states(spark: SparkSession, path: str, start=None, end=None) -> DataFrame:
    """Day states of all batches below ``path``; other years are not read."""
    states = spark.read.schema(STORED).parquet(path)
    if start is not None or end is not None:
        start, end = start or "0001-01-01", end or "9999-12-31"
        years = [F.date_format(F.lit(x).cast("timestamp"), "yyyy") for x in (start, end)]
        states = states.where(F.col("yyyy").between(*years) & in_date_range(F.col("obs_date").cast("timestamp"), start, end))
    return merged(states, ("obs_date",))
