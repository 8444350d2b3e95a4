"""The serving run: publish batch views, add speed views, merge both."""

from __future__ import annotations

import logging
from functools import partial

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from playlake import fixed
from playlake.operators import audience, merge
from playlake.schema import EVENT_DDL
from playlake.session import together
from playlake.sources.catalog import Catalog
from playlake.sources.files import (
    LANDED_DDL,
    is_missing,
    publish,
    read_events,
    read_landed,
    read_view,
)
from playlake.sources.versions import write_version
from playlake.streaming.plays import BATCH_FOLDERS

log = logging.getLogger(__name__)


def speed_events(spark: SparkSession, path: str) -> DataFrame:
    """The speed table with its folders, or an empty one before the stream has written any."""
    try:
        return read_landed(spark, path)
    except AnalysisException as missing:
        if not is_missing(missing):
            raise
        log.warning("no speed events below %s", path)
        return spark.createDataFrame([], f"{EVENT_DDL}, {LANDED_DDL}")


def run_serving(
    spark: SparkSession,
    store: str,
    speed_path: str,
    target: str,
    overlap: bool = False,
    names: list[str] = fixed.PUBLISHED_VIEWS,
) -> dict[str, int | None]:
    """Write all published, speed and merged views below ``target``.

    ``names`` are the stored views to publish; missing ones are skipped.

    Speed views cover the whole speed table. Micro-batches that the batch run had
    read (it kept a mark of them) are left out of the merges, because the batch
    layer holds them already; ``overlap=True`` adds them on top. Event times play
    no part, so late and future-dated events are counted once.
    """
    written = publish(spark, store, target, names)
    batch = read_events(spark, f"{store}/clean")
    speed = speed_events(spark, speed_path)
    fresh = speed if overlap else merge.speed_after(read_view(spark, f"{store}/landed_until"), speed)

    def published(name: str) -> DataFrame:
        return read_view(spark, f"{store}/{name}")

    # Exact over both layers, from the sets that the batch run stored; its events are not read again.
    arrived = audience.hour_users(fresh, "ingestion_time")
    tables = {
        "speed_top_songs": merge.speed_top_songs(speed),
        "speed_top_artists": merge.speed_top_artists(speed),
        "speed_active_ts": merge.speed_active_ts(speed),
        "speed_level": merge.speed_level(speed),
        "speed_summary": merge.speed_summary(batch, speed),
        "merged_top_songs": merge.merged_top_songs(published("top_songs"), merge.speed_top_songs(fresh)),
        "merged_top_artists": merge.merged_top_artists(published("top_artists"), merge.speed_top_artists(fresh)),
        "merged_active_ts": merge.merged_active_ts(published("active_users_ts"), merge.speed_active_ts(fresh)),
        "merged_active_users": audience.merged_active_users(published("hour_users"), arrived),
        "merged_listeners": audience.merged_listeners(published("song_users"), audience.song_users(fresh)),
    }
    # None needs another, so their jobs share the cores.
    steps = {name: partial(write_version, df, f"{target}/{name}") for name, df in tables.items()}
    written.update(together(spark, steps))
    return written


def load_catalog(
    spark: SparkSession,
    database: str,
    clean_path: str,
    speed_path: str | None = None,
    location: str | None = None,
    speed_folders: str | None = BATCH_FOLDERS,
) -> Catalog:
    """Declare the event tables and build the view tables of a database.

    Without a speed path only the batch tables are built.
    """
    catalog = Catalog(spark, database, location)
    catalog.play_events(clean_path)
    catalog.top_songs()
    catalog.top_artists()
    catalog.plays_by_hour()
    catalog.level_stats()
    if speed_path is not None:
        catalog.streaming_events(speed_path, speed_folders)
        catalog.merged_events()
        catalog.merged_songs()
        catalog.merged_artists()
    return catalog
