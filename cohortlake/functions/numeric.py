"""Rounding and guarded division, all in doubles."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def half_up(value: Column, digits: int) -> Column:
    """Round half away from zero on the double itself.

    ``F.round`` goes through the decimal text of a double and so differs on
    values such as 1.005. Nothing passes through an integer, so large values stay.
    """
    factor = float(10**digits)
    scaled = F.abs(value.cast("double")) * F.lit(factor)
    rest = scaled % F.lit(1.0)
    up = F.when(rest >= 0.5, 1.0).otherwise(0.0)
    return F.signum(value) * (scaled - rest + up) / F.lit(factor)


def ratio(numerator: Column, denominator: Column, digits: int, scale: float = 1.0) -> Column:
    """``scale * numerator / denominator`` rounded; NULL where the denominator is 0 or NULL."""
    return half_up(F.lit(float(scale)) * numerator / F.nullif(denominator, F.lit(0)), digits)
