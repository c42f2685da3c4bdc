"""Small driver-side tables and the size check in front of every broadcast hint."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skygrid.session import shared_dir

# A hint is given only below this many rows, counted on the driver before planning.
# Larger sides get no hint: Spark sizes them itself and shuffles when they do not fit.
BROADCAST_ROWS = 1_000_000


def dimension(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A table made of driver-side literals, broadcast while its length is within the bound."""
    return hint_if_bounded(spark.createDataFrame(list(rows), schema), len(rows))


def hint_if_bounded(df: DataFrame, row_bound: int) -> DataFrame:
    """Broadcast ``df`` when ``row_bound``, an upper bound known on the driver, is small."""
    return F.broadcast(df) if row_bound <= BROADCAST_ROWS else df


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written below the shared folder and read back; lineage ends here."""
    spark = df.sparkSession
    path = shared_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fact_table(df: DataFrame, name: str) -> DataFrame:
    """A small aggregate, one row a granule or day, written once and counted before it meets the pixels.

    Every later use reads the file instead of planning the aggregate again. Spark sizes an aggregate by its
    input and would sort the pixel table for the join; a counted table within the bound is broadcast, a longer one is
    left to Spark.
    """
    table = stored(df, name)
    return hint_if_bounded(table, table.count())
