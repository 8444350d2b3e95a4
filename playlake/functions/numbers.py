"""Rounding and ratios."""

from pyspark.sql import Column, functions as F

# Sums of doubles differ in their last bits with the order of partitions. Nine
# decimals are far coarser than that noise and far finer than any report, so
# rounding twice gives the same report after a retry or a different layout.
NOISE_DECIMALS = 9


def half_up(value: Column, places: int) -> Column:
    return F.round(F.round(value, NOISE_DECIMALS), places)


def percent(part: Column, whole: Column, places: int = 1) -> Column:
    """``part`` in percent of ``whole``; null when there is no whole."""
    return half_up(F.try_divide(part, whole) * 100, places)
