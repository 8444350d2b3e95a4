"""Keyed counts: plays per artist, hour and user."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from playlake.functions.times import from_millis, utc_hour_key


def count_by(events: DataFrame, key: Column) -> DataFrame:
    """(key, n) per text key; rows without a key are dropped."""
    keyed = events.select(key.cast("string").alias("key")).filter(F.col("key") != "")
    return keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n"))


def count_by_artist_key(events: DataFrame) -> DataFrame:
    return count_by(events, F.col("artist"))


def count_by_hour_key(events: DataFrame) -> DataFrame:
    """Per UTC hour "00".."23"; a missing or zero ``ts`` has no hour."""
    known = F.when(F.col("ts") != 0, F.col("ts"))
    return count_by(events, utc_hour_key(known))


def count_by_user_key(events: DataFrame) -> DataFrame:
    return count_by(events, F.col("userId"))


def group_count(events: DataFrame, key: str) -> DataFrame:
    """Rows per value, the null group included."""
    return events.groupBy(key).count()


def bench_top_artists(events: DataFrame) -> DataFrame:
    return group_count(events, "artist")


def bench_plays_by_hour(events: DataFrame) -> DataFrame:
    return group_count(events.select(F.hour(from_millis(F.col("ts"))).alias("hour")), "hour")


def bench_user_sessions(events: DataFrame) -> DataFrame:
    return group_count(events, "userId")
