"""The batch run: clean once, tally once, then every view from the smallest table that holds it."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession, functions as F

from playlake import fixed
from playlake.operators import clean as cleaning
from playlake.operators import audience, features, merge, views
from playlake.plans.models import run_churn, run_segments
from playlake.schema import EVENT_COLUMNS
from playlake.session import prepare, size_for, together
from playlake.sources.files import read_events, read_landed, read_view, require_events, stored_bytes, write_parquet


def run_batch(
    spark: SparkSession,
    raw_path: str,
    store: str,
    models: bool = True,
    input_bytes: int | None = None,
) -> dict[str, int]:
    """Rebuild the store from raw events; returns rows written per table.

    ``raw`` and ``dropped`` are added to the counts; they come from the page
    distribution and the clean table, not from scans of their own. The table
    ``landed_until`` marks the micro-batches that were read.

    Scans and shuffles are cut for the size of the raw table: the one given, or
    what the listing of its files says.

    Events are scanned for the clean table, the two tallies, the sessions, the
    overview and the early-period features. All other views and the segments
    read those smaller tables, and every step hands over through files, so a
    lost executor repeats one step only. Tables that don't need each other are
    written at the same time.
    """
    prepare(spark)
    require_events(spark, raw_path)
    size_for(spark, input_bytes or stored_bytes(spark, raw_path))
    # One listing for the mark and the clean table: what lands later is in neither.
    landed = read_landed(spark, raw_path)
    raw = landed.select(*EVENT_COLUMNS)
    written: dict[str, int] = {}

    def put(**views_: DataFrame) -> dict[str, DataFrame]:
        """Write tables that don't need each other at the same time, and read them back."""
        steps = {name: partial(write_parquet, df, f"{store}/{name}") for name, df in views_.items()}
        written.update(together(spark, steps))
        return {name: read_view(spark, f"{store}/{name}") for name in views_}

    put(landed_until=merge.landed_until(landed), clean=cleaning.clean_events(raw))
    clean = read_events(spark, f"{store}/clean")
    held = put(
        listener_tracks=views.listener_tracks(clean),
        listener_hours=views.listener_hours(clean),
        session_stats=views.session_stats(clean),
        overview=views.overview(clean),
        page_dist=views.page_dist(raw),
    )
    tracks, hours, sessions = held["listener_tracks"], held["listener_hours"], held["session_stats"]
    written["raw"] = held["page_dist"].agg(F.sum("event_count")).first()[0]
    written["dropped"] = written["raw"] - written["clean"]
    held = put(
        top_songs=views.top_songs(tracks),
        top_artists=views.top_artists(tracks),
        retention=views.retention(hours),
        plays_by_hour=views.plays_by_hour(hours),
        hour_users=audience.hour_users(hours),
        active_users_ts=views.active_users_ts(hours),
        song_users=audience.song_users(tracks),
        top_locations=views.top_locations(tracks),
        level_stats=views.level_stats(tracks),
        level_ratio=views.level_ratio(tracks),
        gender_stats=views.gender_stats(tracks),
        first_play=views.first_play(hours),
        session_dist=views.session_dist(sessions),
    )
    put(
        top10_songs=views.top(held["top_songs"], "play_count", fixed.TOP_VIEW, "song", "artist"),
        top10_artists=views.top(held["top_artists"], "play_count", fixed.TOP_VIEW, "artist"),
    )
    if models:
        run_segments(spark, features.user_features_of_tables(tracks, hours, sessions), store)
        run_churn(spark, clean, store)
    return written
