"""Speed views and the merge of batch and speed results.

The merges add what they are given. A micro-batch should be in one of the inputs
only (see ``plans.serving``), or its events are counted twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from playlake import fixed
from playlake.functions.measures import distinct, plays, summarise
from playlake.operators.clean import filter_page
from playlake.schema import PAYLOAD_COLUMNS

NO_INGESTION = "N/A"
MERGED_ZERO = ["play_count", "stream_plays", "unique_listeners", "stream_listeners"]


def _speed_audience(speed: DataFrame, keys: list[str], users: str) -> DataFrame:
    return summarise(speed, keys, stream_plays=plays, **{users: distinct("userId")})


def speed_top_songs(speed: DataFrame) -> DataFrame:
    return _speed_audience(speed, ["song", "artist"], "stream_listeners")


def speed_top_artists(speed: DataFrame) -> DataFrame:
    return _speed_audience(speed, ["artist"], "stream_listeners")


def speed_level(speed: DataFrame) -> DataFrame:
    return _speed_audience(speed, ["level"], "stream_users")


def speed_active_ts(speed: DataFrame, time_column: str = "ingestion_time") -> DataFrame:
    """Users and plays per hour of arrival (or of another time column)."""
    hourly = speed.withColumn("hour_bucket", F.date_trunc("hour", time_column))
    return summarise(hourly, ["hour_bucket"], active_users=distinct("userId"), total_plays=plays)


def speed_summary(batch: DataFrame, speed: DataFrame) -> DataFrame:
    """One row: rows per layer and the latest arrival (``N/A`` without any)."""
    latest = F.max("ingestion_time").cast("string")
    batch_total = batch.agg(F.count(F.lit(1))).scalar()
    return speed.agg(
        F.count(F.lit(1)).alias("stream_total"),
        F.coalesce(latest, F.lit(NO_INGESTION)).alias("latest_ingestion"),
    ).select("stream_total", batch_total.alias("batch_total"), "latest_ingestion")


def _merge(batch_view: DataFrame, speed_view: DataFrame, keys: list[str]) -> DataFrame:
    """Full outer join of two views that hold one row per key.

    Both sides leave their aggregation partitioned by the keys, so the join
    moves no rows again and has no hot key. Null keys match nothing.
    """
    both = batch_view.join(speed_view, keys, "full").fillna(0, subset=MERGED_ZERO)
    return both.withColumn("merged_plays", F.col("play_count") + F.col("stream_plays"))


def merged_top_songs(batch_songs: DataFrame, speed_songs: DataFrame) -> DataFrame:
    return _merge(batch_songs, speed_songs, ["song", "artist"])


def merged_top_artists(batch_artists: DataFrame, speed_artists: DataFrame) -> DataFrame:
    return _merge(batch_artists, speed_artists, ["artist"])


def merged_active_ts(batch_hours: DataFrame, speed_hours: DataFrame) -> DataFrame:
    """Sum of both timelines. A user active in both layers counts in each."""
    return (
        batch_hours.unionByName(speed_hours)
        .groupBy("hour_bucket")
        .agg(F.sum("active_users").alias("active_users"), F.sum("total_plays").alias("total_plays"))
    )


def merged_events(batch: DataFrame, speed: DataFrame, filter_batch: bool = True) -> DataFrame:
    """Payload of both layers with its source."""
    held = filter_page(batch) if filter_batch else batch
    return held.select(*PAYLOAD_COLUMNS, F.lit("batch").alias("data_source")).unionByName(
        speed.select(*PAYLOAD_COLUMNS, F.lit("stream").alias("data_source"))
    )


def songs_by_source(merged: DataFrame) -> DataFrame:
    return summarise(
        merged,
        ["song", "artist", "data_source"],
        play_count=plays,
        unique_listeners=distinct("userId"),
    )


def artists_by_source(merged: DataFrame) -> DataFrame:
    return summarise(
        merged,
        ["artist", "data_source"],
        play_count=plays,
        unique_listeners=distinct("userId"),
    )


def records_by_source(merged: DataFrame) -> DataFrame:
    return merged.groupBy("data_source").agg(F.count(F.lit(1)).alias("records"))


def landed_until(landed: DataFrame) -> DataFrame:
    """(run, last_batch): the newest micro-batch of each stream among landed rows."""
    streams = landed.filter(F.col("run").isNotNull()).groupBy("run")
    return streams.agg(F.max("batch_id").alias("last_batch"))


def speed_after(mark: DataFrame, speed: DataFrame) -> DataFrame:
    """Speed rows that landed after what a batch run had read, whatever their event time.

    ``mark`` is :func:`landed_until` of that run. Rows of other streams, and rows
    outside a stream's folders, are all kept.
    """
    joined = speed.join(mark, "run", "left")
    return joined.filter(F.col("last_batch").isNull() | (F.col("batch_id") > F.col("last_batch")))


def live_feed(speed: DataFrame, rows: int = fixed.LIVE_ROWS) -> DataFrame:
    """The events that arrived last."""
    shown = ["artist", "song", "userId", "level", "location"]
    ties = ["ts", "userId", "sessionId"]
    newest = speed.orderBy(F.desc("ingestion_time"), *[F.desc(t) for t in ties]).limit(rows)
    return newest.select(*shown)
