"""Which cells were observed, as bits: one long for 64 neighbouring columns of a grid row.

A long is what Spark's hash aggregate can update in place, so the union of any number of slices is one ``bit_or`` that is combined
map-side; the built-in bitmap aggregates hold a byte array, for which Spark sorts all rows instead. A word keeps its grid row,
so a weight by latitude is the row's weight times a count of bits.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skygrid.functions.geo import cell_weight
from skygrid.operators.region import box_of, zone_mask
from skygrid.plans.dimension import hint_if_bounded
from skygrid.plans.grid import GridSpec

WORD_BITS = 6
WORD = 1 << WORD_BITS


def _bit(j: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), j.bitwiseAND(WORD - 1).cast("int"))


def cell_words(cells: DataFrame, keys: Sequence[str | Column]) -> DataFrame:
    """``keys``, i, w, bits: the cells (i, j) of each key, bit j % 64 of word j // 64. Repeated cells count once."""
    return (cells.groupBy(*keys, "i", F.shiftright("j", WORD_BITS).alias("w"))
            .agg(F.bit_or(_bit(F.col("j"))).alias("bits")))


def union_words(words: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Cells that any of the rows has. The union of unions is the union, and a row met twice changes nothing."""
    return words.groupBy(*keys, "i", "w").agg(F.bit_or("bits").alias("bits"))


def _box_mask(first: int, last: int) -> Column:
    """Bits of word ``w`` that lie in the columns ``first`` to ``last``."""
    low = F.greatest(F.lit(first) - F.col("w") * WORD, F.lit(0)).cast("int")
    high = F.least(F.lit(last) - F.col("w") * WORD, F.lit(WORD - 1)).cast("int")
    ones = F.call_function("shiftrightunsigned", F.lit(-1).cast("long"), F.lit(WORD - 1) - (high - low))
    return F.when(high >= low, F.call_function("shiftleft", ones, low)).otherwise(F.lit(0).cast("long"))


def region_words(words: DataFrame, grid: GridSpec, region, vertices: DataFrame | None = None) -> DataFrame:
    """``words`` with the bits of a region only: arithmetic on rows and columns for a box, a mask of as many bits for a zone."""
    bounds = box_of(region, vertices)
    if bounds is not None:
        lats, lons = grid.lats(), grid.lons()
        rows = ((lats >= bounds[2]) & (lats <= bounds[3])).nonzero()[0]
        cols = ((lons >= bounds[0]) & (lons <= bounds[1])).nonzero()[0]
        if not (rows.size and cols.size):
            return words.where(F.lit(False))
        first, last = int(cols[0]), int(cols[-1])
        # The ranges of rows and words reach the scan of a stored table.
        return (words.where(F.col("i").between(int(rows[0]), int(rows[-1])) & F.col("w").between(first >> WORD_BITS, last >> WORD_BITS))
                .withColumn("bits", F.col("bits").bitwiseAND(_box_mask(first, last))))
    if vertices is None:
        raise ValueError("a zone needs its county outlines")
    mask = cell_words(zone_mask(vertices.where(F.col("zone") == region), grid), []).withColumnRenamed("bits", "mask")
    masked = words.join(hint_if_bounded(mask, grid.nlat * (-(-grid.nlon // WORD))), ["i", "w"])
    return masked.withColumn("bits", F.col("bits").bitwiseAND(F.col("mask"))).drop("mask")


def covered_weight(words: DataFrame, grid: GridSpec, keys: Sequence[str], weight: str = "count") -> DataFrame:
    """``keys``, valid: the weight of the cells whose bit is set, each word's count times the weight of its row."""
    w = cell_weight(grid.lat_of(F.col("i")), weight) * F.bit_count("bits")
    return words.groupBy(*keys).agg(F.sum(w).alias("valid"))
