"""Measures that read events and tallies alike.

A *tally* is events rolled up to some keys, carrying the additive columns
``plays``, ``seconds`` (sum of durations) and ``timed`` (plays with a
duration). Clean events are the finest tally, so a view is written once and
runs on the events or, inside a batch run, on a much smaller stored tally.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from playlake.functions.numbers import half_up

Measure = Callable[[DataFrame], Column]


def is_tally(df: DataFrame) -> bool:
    return "plays" in df.columns


def plays(df: DataFrame) -> Column:
    if is_tally(df):
        return F.coalesce(F.sum("plays"), F.lit(0).cast("bigint"))
    return F.count(F.lit(1))


def seconds(df: DataFrame) -> Column:
    return F.sum("seconds" if is_tally(df) else "duration")


def timed(df: DataFrame) -> Column:
    return F.sum("timed") if is_tally(df) else F.count("duration")


def last_seen(df: DataFrame) -> Column:
    return F.max("last_seen" if is_tally(df) else "event_ts")


def mean_seconds(df: DataFrame) -> Column:
    return half_up(F.try_divide(seconds(df), timed(df)), 1)


def hours_played(df: DataFrame) -> Column:
    return half_up(seconds(df) / 3600, 2)


def minutes_played(df: DataFrame) -> Column:
    return half_up(seconds(df) / 60, 1)


def distinct(column: str) -> Measure:
    """Exact distinct count. Spark shuffles on (keys, column), so a hot key is
    spread over tasks by the counted column."""

    def measure(df: DataFrame) -> Column:
        return F.count_distinct(column)

    measure.counts_distinct = True
    return measure


def approx_distinct(column: str) -> Measure:
    """HyperLogLog count: one fixed-size sketch per key, for streams and
    inputs whose exact distinct sets are too large to shuffle."""
    return lambda df: F.approx_count_distinct(column)


def combine(keys: list[str], parts: list[DataFrame]) -> DataFrame:
    """Side by side the columns of frames that each hold one row per key.

    A union and one more aggregation of finished rows: one shuffle however many
    parts there are, and null keys meet, which they would not in a join.
    """
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    held = [F.max(c).alias(c) for c in stacked.columns if c not in keys]
    return stacked.groupBy(*keys).agg(*held)


def summarise(df: DataFrame, keys: list[str], **measures: Measure) -> DataFrame:
    """One row per key with the named measures.

    Several distinct counts in one aggregation would copy every row once per
    count, each copy as wide as all counted columns. Counting each column in a
    pass of its own reads only that column and the keys.
    """
    counts = [n for n, m in measures.items() if getattr(m, "counts_distinct", False)]
    passes = [{n: m for n, m in measures.items() if n not in counts[1:]}]
    passes += [{n: measures[n]} for n in counts[1:]]
    parts = [
        df.groupBy(*keys).agg(*[measure(df).alias(name) for name, measure in each.items()])
        for each in passes
    ]
    if len(parts) == 1:
        return parts[0]
    return combine(keys, parts).select(*keys, *measures)


def tally(df: DataFrame, *keys: str, **more: Measure) -> DataFrame:
    """Roll events or a finer tally up to ``keys``, with ``more`` additive measures."""
    return summarise(df, list(keys), plays=plays, seconds=seconds, timed=timed, **more)
