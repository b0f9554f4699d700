"""Numeric columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_half_even(value: Column, digits: int = 2) -> Column:
    """Round the exact binary value, ties to even.

    ``F.round`` and ``F.bround`` round the shortest decimal text of a double, so
    2.675 (stored just below) would go up. Here ``value * 10**digits`` is formed
    without error as ``scaled + rest`` by splitting the value into two halves of
    26 bits, and ``rest`` settles the cases that look like ties.
    """
    factor = F.lit(float(10**digits))
    spread = value * F.lit(134217729.0)
    high = spread - (spread - value)
    low = value - high
    scaled = high * factor + low * factor
    rest = (high * factor - scaled) + low * factor
    nearest = F.rint(scaled)
    offset = scaled - nearest
    adjusted = (
        F.when((offset == 0.5) & (rest > 0), nearest + 1.0)
        .when((offset == -0.5) & (rest < 0), nearest - 1.0)
        .otherwise(nearest)
    )
    # Adding zero turns -0.0 into 0.0.
    return adjusted / factor + F.lit(0.0)


def percent(part: Column, whole: Column) -> Column:
    """``part`` of ``whole`` in percent; NULL when there is nothing to divide by."""
    return F.try_divide(part.cast("double"), whole.cast("double")) * F.lit(100.0)
