"""Sets of users kept beside the counts, so that distinct counts of tables add up.

A stored distinct count can't be merged with another one: a user in both would
count twice. These tables keep the users themselves, as bitmaps. A row is one key
and one stretch of 32,768 user ids (``user_bucket``), with the bitmap of the users
seen and the additive columns of a tally. Two tables of a key are merged by an
``OR`` of bitmaps, and rolled up to a coarser key (hours to days) in the same way,
without another look at the events.

A row's size is fixed whatever the number of plays, and a key with more users has more
rows, so neither a hot key nor a hot user makes a large one. Users without an id are in
no set; their plays stand in a row whose ``user_bucket`` is null.

Where a few percent of error will do, :func:`listener_sketches` holds one HyperLogLog
sketch per key instead, a few KB whatever the number of users.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from playlake.functions.measures import plays
from playlake.functions.numbers import half_up
from playlake.functions.times import with_hour_bucket

SKETCH_BITS = 12  # an error of about 1.6 %


def user_sets(facts: DataFrame, *keys: str) -> DataFrame:
    """(keys, user_bucket, users, plays) of events or a tally that holds ``userId``."""
    return facts.groupBy(*keys, F.bitmap_bucket_number("userId").alias("user_bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("userId")).alias("users"), plays(facts).alias("plays")
    )


def rolled(sets: DataFrame, *keys: str) -> DataFrame:
    """Sets of coarser keys, or of the same keys once they come from several tables."""
    return sets.groupBy(*keys, "user_bucket").agg(
        F.bitmap_or_agg("users").alias("users"), F.sum("plays").alias("plays")
    )


def merged(*tables: DataFrame) -> DataFrame:
    """All rows of tables of sets with the same keys; sets of one key stay apart until rolled."""
    return reduce(DataFrame.unionByName, tables)


def counted(sets: DataFrame, *keys: str, users: str = "active_users", total: str = "total_plays") -> DataFrame:
    """Distinct users and plays per key, exact."""
    return (
        rolled(sets, *keys)
        .groupBy(*keys)
        .agg(F.sum(F.bitmap_count("users")).alias(users), F.sum("plays").alias(total))
    )


def hour_users(facts: DataFrame, time_column: str | None = None) -> DataFrame:
    """Sets per hour of the event, or of another time column."""
    if time_column:
        facts = facts.withColumn("hour_bucket", F.date_trunc("hour", time_column))
    return user_sets(with_hour_bucket(facts), "hour_bucket")


def song_users(facts: DataFrame) -> DataFrame:
    """Sets per song and artist."""
    return user_sets(facts, "song", "artist")


def merged_active_users(batch_hours: DataFrame, speed_hours: DataFrame) -> DataFrame:
    """Users and plays per hour over both layers; a user of both counts once."""
    return counted(merged(batch_hours, speed_hours), "hour_bucket")


def merged_listeners(batch_songs: DataFrame, speed_songs: DataFrame) -> DataFrame:
    """Listeners and plays per song over both layers; a listener of both counts once."""
    both = merged(batch_songs, speed_songs)
    return counted(both, "song", "artist", users="unique_listeners", total="merged_plays")


def active_users_per(hours: DataFrame, unit: str) -> DataFrame:
    """Users and plays per day, week, month, ... from the sets of hours."""
    return counted(hours.withColumn("period", F.date_trunc(unit, "hour_bucket")), "period")


def stickiness(hours: DataFrame) -> DataFrame:
    """Per month: its users, the mean of its active days' users, and their ratio in percent."""
    days = active_users_per(hours, "day").withColumn("month", F.date_trunc("month", "period"))
    daily = days.groupBy("month").agg(F.sum("active_users").alias("user_days"), F.count(F.lit(1)).alias("days"))
    months = active_users_per(hours, "month").select(F.col("period").alias("month"), F.col("active_users").alias("users"))
    mean = F.col("user_days") / F.col("days")
    return months.join(daily, "month").select(
        "month",
        "users",
        F.col("days").alias("active_days"),
        half_up(mean, 2).alias("mean_daily_users"),
        half_up(F.try_divide(mean * 100, F.col("users")), 2).alias("stickiness_pct"),
    )


def listener_sketches(facts: DataFrame, *keys: str) -> DataFrame:
    """(keys, sketch, plays): a sketch of the users of each key."""
    return facts.groupBy(*keys).agg(
        F.hll_sketch_agg("userId", F.lit(SKETCH_BITS)).alias("sketch"), plays(facts).alias("plays")
    )


def estimated(sketches: DataFrame, *keys: str) -> DataFrame:
    """Estimated distinct users and exact plays per key of one or several tables of sketches."""
    return sketches.groupBy(*keys).agg(
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("approx_listeners"), F.sum("plays").alias("play_count")
    )
