"""Numeric column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_even(value: Column, digits: int = 0) -> Column:
    """Round half to even after scaling, as numpy does."""
    if digits == 0:
        return F.rint(value.cast("double"))
    scale = F.lit(float(10**digits))
    return F.rint(value.cast("double") * scale) / scale


def truncate(value: Column, guard: int = 4) -> Column:
    """Whole part of a number. The guard digits keep 2.9999999999 from becoming 2."""
    return round_even(value, guard).cast("long")


def floor_guarded(value: Column, guard: int = 6) -> Column:
    return F.floor(round_even(value, guard)).cast("long")


def clamp_low(value: Column, low: float = 0.0) -> Column:
    """Values below the bound become the bound; null stays null."""
    return F.when(value < low, F.lit(low)).otherwise(value)


def finite_or_zero(value: Column) -> Column:
    """Infinite, NaN and null values become 0."""
    bad = value.isNull() | F.isnan(value) | value.isin(float("inf"), float("-inf"))
    return F.when(bad, F.lit(0.0)).otherwise(value)


def guarded_ratio(top: Column, bottom: Column) -> Column:
    """top / bottom, or top itself where bottom is 0."""
    top, bottom = top.cast("double"), bottom.cast("double")
    return F.when(bottom == 0, top).otherwise(F.try_divide(top, bottom))


def scaled_ratio(value: Column, days: int = 30) -> Column:
    """Minutes of use as a share of all minutes of the period."""
    return value.cast("double") / F.lit(float(1440 * days))


def cut_points(value: Column, cuts: list[float]) -> Column:
    """1 for values below the first cut, 2 below the second, and so on."""
    bucket = F.lit(None).cast("long")
    for position in range(len(cuts), 0, -1):
        bucket = F.when(value < F.lit(cuts[position - 1]), F.lit(position)).otherwise(bucket)
    last = F.when(value >= F.lit(cuts[-1]), F.lit(len(cuts) + 1))
    return F.coalesce(last, bucket).cast("long")


def equal_width(value: Column, largest: Column, bins: int) -> Column:
    """0-based bin of a value among right-closed bins of equal whole width.

    The edges are 0, step, 2*step, ... below the whole part of the largest value,
    with step = whole part of largest / bins and at least 1. Values at or below 0
    and above the last edge have no bin.
    """
    top = largest.cast("long")
    step = F.greatest(F.lit(1).cast("long"), (largest.cast("double") / F.lit(float(bins))).cast("long"))
    last = F.floor((top - F.lit(1)) / step) * step
    return F.when(
        (value > 0) & (value <= last),
        F.ceil(value.cast("double") / step.cast("double")) - F.lit(1),
    ).cast("long")
