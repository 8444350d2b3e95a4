"""Text labels and small text functions."""

from pyspark.sql import Column, functions as F

from playlake import fixed


def state_of(location: Column) -> Column:
    """Text after the last comma of ``City, ST``; the whole text without one."""
    return F.trim(F.substring_index(location, ",", -1))


def user_type(day: Column, first_day: Column) -> Column:
    return F.when(day == first_day, "new").otherwise("returning")


def risk_band(probability: Column) -> Column:
    return (
        F.when(probability >= fixed.HIGH_RISK, "High")
        .when(probability >= fixed.MEDIUM_RISK, "Medium")
        .otherwise("Low")
    )


def low_engagement(plays_per_day: Column, active_days: Column, daily_bar: Column, days_bar: Column) -> Column:
    """1 for a user at or below both bars, else 0."""
    both = (plays_per_day <= daily_bar) & (active_days <= days_bar)
    return F.when(both, 1).otherwise(0)


def segment_name(rank: Column) -> Column:
    """Name of the segment at ``rank`` (0 = most plays), ``Segment n`` beyond the named ones."""
    names = F.array(*[F.lit(name) for name in fixed.SEGMENT_LABELS])
    return F.coalesce(F.get(names, rank), F.concat(F.lit("Segment "), rank.cast("string")))
