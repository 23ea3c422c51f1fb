"""Speed arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: miles per hour in one metre per second.
MPH = 2.2369


def round_half_up(x: Column) -> Column:
    """Nearest integer, halves towards positive infinity."""
    return F.floor(x + F.lit(0.5)).cast("int")


def whole_mph(distance: Column, duration: Column) -> Column:
    """Metres per time unit truncated to an integer, then in mph; null if no time passed."""
    whole = F.call_function("div", F.abs(distance), F.nullif(F.abs(duration), F.lit(0)))
    return F.lit(MPH) * whole


def exact_mph(distance: Column, duration: Column) -> Column:
    """mph as a double; null if no time passed."""
    return F.lit(MPH) * F.abs(distance) / F.nullif(F.abs(duration), F.lit(0))
