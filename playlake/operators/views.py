"""Batch views. Each takes clean events, or a tally that holds its keys.

No view sorts its whole result: a total order written to files is lost on the
next read. Order is applied where it decides the rows, that is with a limit,
and always with the keys as tie-break.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from playlake import fixed
from playlake.functions.labels import state_of, user_type
from playlake.functions.measures import (
    approx_distinct,
    distinct,
    hours_played,
    last_seen,
    mean_seconds,
    minutes_played,
    plays,
    summarise,
    tally,
)
from playlake.functions.numbers import half_up, percent
from playlake.functions.times import minutes_between, with_hour_bucket, with_play_date


def top(view: DataFrame, measure: str, rows: int, *ties: str) -> DataFrame:
    """The ``rows`` largest by ``measure``: per-task heaps, merged once."""
    return view.orderBy(F.desc(measure), *[F.asc(t) for t in ties]).limit(rows)


def overview(events: DataFrame, approx: bool = False) -> DataFrame:
    """Totals of all plays; ``approx`` counts distinct values by sketch, in one pass."""
    count = approx_distinct if approx else distinct
    return summarise(
        events,
        [],
        total_plays=plays,
        unique_users=count("userId"),
        unique_artists=count("artist"),
        unique_songs=count("song"),
        total_sessions=count("sessionId"),
        avg_duration_sec=mean_seconds,
        min_duration_sec=lambda df: half_up(F.min("duration"), 1),
        max_duration_sec=lambda df: half_up(F.max("duration"), 1),
    )


def top_songs(facts: DataFrame, approx: bool = False) -> DataFrame:
    count = approx_distinct if approx else distinct
    return summarise(
        facts,
        ["song", "artist"],
        play_count=plays,
        unique_listeners=count("userId"),
        avg_duration_sec=mean_seconds,
    )


def top_artists(facts: DataFrame, approx: bool = False) -> DataFrame:
    count = approx_distinct if approx else distinct
    return summarise(
        facts,
        ["artist"],
        play_count=plays,
        unique_listeners=count("userId"),
        unique_songs=count("song"),
    )


def top10_songs(facts: DataFrame) -> DataFrame:
    return top(top_songs(facts), "play_count", fixed.TOP_VIEW, "song", "artist")


def top10_artists(facts: DataFrame) -> DataFrame:
    return top(top_artists(facts), "play_count", fixed.TOP_VIEW, "artist")


def top_locations(facts: DataFrame, rows: int = fixed.TOP_LOCATIONS) -> DataFrame:
    placed = facts.withColumn("state", state_of(F.col("location")))
    by_state = summarise(placed, ["state"], play_count=plays, unique_users=distinct("userId"))
    return top(by_state, "play_count", rows, "state")


def plays_by_hour(facts: DataFrame, with_duration: bool = True) -> DataFrame:
    """Plays per hour of day; ``with_duration=False`` gives the two-measure form."""
    hourly = with_hour_bucket(facts).withColumn("hour_of_day", F.hour("hour_bucket"))
    measures = {"play_count": plays, "active_users": distinct("userId")}
    if with_duration:
        measures["avg_duration_sec"] = mean_seconds
    return summarise(hourly, ["hour_of_day"], **measures)


def level_stats(facts: DataFrame) -> DataFrame:
    return summarise(
        facts,
        ["level"],
        play_count=plays,
        user_count=distinct("userId"),
        avg_duration_sec=mean_seconds,
    )


def gender_stats(facts: DataFrame) -> DataFrame:
    return summarise(
        facts,
        ["gender"],
        play_count=plays,
        user_count=distinct("userId"),
        avg_duration_sec=mean_seconds,
    )


def page_dist(raw: DataFrame) -> DataFrame:
    """Events per page, over raw events of every page."""
    return summarise(raw, ["page"], event_count=plays, unique_users=distinct("userId"))


def level_ratio(facts: DataFrame) -> DataFrame:
    """Level mix with each level's share of the (user, level) pairs.

    Rolling up to (level, userId) first makes distinct users and pairs plain
    counts. The grand total is then taken over the finished rows, of which
    there is one per subscription level.
    """
    per_user = tally(facts, "level", "userId")
    mix = summarise(
        per_user,
        ["level"],
        play_count=plays,
        user_count=lambda df: F.count("userId"),
        avg_duration_sec=mean_seconds,
        total_hours_played=hours_played,
        pairs=lambda df: F.count(F.lit(1)),
    )
    all_pairs = F.sum("pairs").over(Window.partitionBy())
    return mix.withColumn("user_pct", percent(F.col("user_count"), all_pairs)).drop("pairs")


def session_stats(events: DataFrame) -> DataFrame:
    sessions = summarise(
        events,
        ["userId", "sessionId"],
        songs_per_session=plays,
        session_minutes=minutes_played,
        session_start=lambda df: F.min("event_ts"),
        session_end=lambda df: F.max("event_ts"),
    )
    length = minutes_between(F.col("session_end"), F.col("session_start"))
    return sessions.withColumn("session_duration_min", length)


def session_dist(sessions: DataFrame) -> DataFrame:
    """Sessions per length, from :func:`session_stats`; averages its rounded minutes."""
    return sessions.groupBy("songs_per_session").agg(
        F.count(F.lit(1)).alias("session_count"),
        half_up(F.avg("session_minutes"), 1).alias("avg_session_minutes"),
    )


def first_play(facts: DataFrame) -> DataFrame:
    return (
        with_play_date(facts).groupBy("userId").agg(F.min("play_date").alias("first_play_date"))
    )


def retention(facts: DataFrame) -> DataFrame:
    """New and returning users per day.

    Events shrink to (user, day) rows before anything looks at a user's whole
    history, so the window sees one row per active day however hot the user,
    and users per day become a plain count.
    """
    known = with_play_date(facts).filter(F.col("userId").isNotNull())
    daily = tally(known, "userId", "play_date")
    first_day = F.min("play_date").over(Window.partitionBy("userId"))
    typed = daily.withColumn("user_type", user_type(F.col("play_date"), first_day))
    return summarise(
        typed,
        ["play_date", "user_type"],
        user_count=lambda df: F.count(F.lit(1)),
        play_count=plays,
    )


def active_users_ts(facts: DataFrame) -> DataFrame:
    return summarise(
        with_hour_bucket(facts),
        ["hour_bucket"],
        active_users=distinct("userId"),
        total_plays=plays,
    )


def distinct_user_levels(events: DataFrame) -> DataFrame:
    return events.select("userId", "level").distinct()


def approx_listeners(facts: DataFrame) -> DataFrame:
    """Listeners per song by sketch: the shuffle carries a fixed size per song."""
    return summarise(
        facts,
        ["song", "artist"],
        play_count=plays,
        approx_listeners=approx_distinct("userId"),
    )


TRACK_KEYS = ["userId", "level", "gender", "location", "artist", "song"]


def listener_tracks(events: DataFrame, *more: str) -> DataFrame:
    """Tally behind the song, artist, level, gender and location views, by ``more`` keys if given.

    ``last_seen`` tells which level of a user is the latest.
    """
    return tally(events, *TRACK_KEYS, *more, last_seen=last_seen)


def listener_hours(events: DataFrame, *more: str) -> DataFrame:
    """Tally behind the hourly, daily and retention views, by ``more`` keys if given."""
    return tally(with_hour_bucket(events), "userId", "hour_bucket", *more)
