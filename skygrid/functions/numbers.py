"""Rounding that does not depend on the order of a sum."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_even(x: Column, digits: int) -> Column:
    """Nearest value with ``digits`` decimals; halves go to the even neighbour."""
    scale = F.lit(float(10 ** digits))
    return F.rint(x * scale) / scale


def mean_of_rounded(x: Column, digits: int) -> Column:
    """Rounded mean of values that have ``digits`` decimals already.

    They are added as whole numbers, so the sum is exact and a mean that falls on a
    half is rounded the same way however the rows were distributed.
    """
    scale = F.lit(float(10 ** digits))
    return F.rint(F.sum(F.rint(x * scale)) / F.count(x)) / scale
