"""The play stream: ingest tables, windowed song counts, running level summary.

Each function takes an event stream from any source. A query without a trigger
interval reads what is available and stops; with one it runs until stopped.
The number of state partitions is ``spark.sql.shuffle.partitions`` at the first
start and stays with the checkpoint, so set it for the cluster before that.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from playlake import fixed
from playlake.functions.measures import approx_distinct, mean_seconds, plays, summarise
from playlake.operators.audience import counted, user_sets
from playlake.operators.clean import drop_incomplete, filter_page, stamp
from playlake.schema import EVENT_COLUMNS
from playlake.sources.files import LANDED_DDL, read_events, read_view
from playlake.sources.messages import parse_messages
from playlake.sources.versions import tidy, write_version

BATCH_FOLDERS = LANDED_DDL
QUERY_ID = "sql.streaming.queryId"  # lives in the checkpoint: a fresh one gets another id


def parsed_events(messages: DataFrame) -> DataFrame:
    """Events of every page with event and processing time; unreadable messages dropped."""
    readable = F.coalesce(F.col("page"), F.col("ts").cast("string"), F.col("userId").cast("string"))
    return stamp(parse_messages(messages)).filter(readable.isNotNull()).select(*EVENT_COLUMNS)


def song_plays(events: DataFrame) -> DataFrame:
    """Complete plays only: the rows of the speed layer."""
    return drop_incomplete(filter_page(events))


def songs_per_window(events: DataFrame) -> DataFrame:
    """Plays per one-minute window and song; batch twin and stream share it.

    On a stream, rows later than the watermark are dropped, and a window is
    emitted once, when the watermark passes its end. Each task counts before
    the shuffle, so a hit song sends one row per window and task.
    """
    watched = events.withWatermark("event_ts", fixed.WATERMARK) if events.isStreaming else events
    windowed = watched.withColumn("window", F.window("event_ts", fixed.WINDOW))
    counted = summarise(
        windowed,
        ["window", "artist", "song"],
        play_count=plays,
        active_users=approx_distinct("userId"),
        avg_duration_sec=mean_seconds,
    )
    return counted.select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        "artist",
        "song",
        "play_count",
        "active_users",
        "avg_duration_sec",
    )


def level_summary(events: DataFrame) -> DataFrame:
    """Running plays, users and artists per level; state is two sketches per level."""
    return summarise(
        events,
        ["level"],
        plays=plays,
        active_users=approx_distinct("userId"),
        unique_artists=approx_distinct("artist"),
    )


def _start(writer: DataStreamWriter, checkpoint: str | None, every: str | None) -> StreamingQuery:
    if checkpoint:
        writer = writer.option("checkpointLocation", checkpoint)
    timed = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return timed.start()


def _write_layers(raw_path: str, speed_path: str) -> Callable[[DataFrame, int], None]:
    def write(batch: DataFrame, batch_id: int) -> None:
        run = batch.sparkSession.sparkContext.getLocalProperty(QUERY_ID)
        folder = f"run={run}/batch_id={batch_id}"
        batch.write.mode("overwrite").parquet(f"{raw_path}/{folder}")
        # The plays come from the files just written: nothing is cached, and
        # neither the source nor the parser runs a second time.
        landed = read_events(batch.sparkSession, f"{raw_path}/{folder}")
        song_plays(landed).write.mode("overwrite").parquet(f"{speed_path}/{folder}")

    return write


def start_ingest(
    events: DataFrame,
    raw_path: str,
    speed_path: str,
    checkpoint: str,
    every: str | None = fixed.SINK_TRIGGER,
) -> StreamingQuery:
    """Land every event in the raw table and the plays in the speed table.

    One query, so the source is read and parsed once for both tables. Each
    micro-batch owns a folder that a repeated batch overwrites: a restart after
    a failure leaves neither gaps nor copies. The folder also names the stream,
    whose id lives with the checkpoint, so a second checkpoint adds to the tables
    and never replaces what another one landed.
    """
    writer = events.writeStream.foreachBatch(_write_layers(raw_path, speed_path))
    return _start(writer, checkpoint, every)


def start_append(
    events: DataFrame, path: str, checkpoint: str, every: str | None = fixed.SINK_TRIGGER
) -> StreamingQuery:
    """Append a stream to one Parquet folder, exactly once."""
    writer = events.writeStream.format("parquet").option("path", path).outputMode("append")
    return _start(writer, checkpoint, every)


def start_window(
    events: DataFrame, path: str, checkpoint: str, every: str | None = fixed.SINK_TRIGGER
) -> StreamingQuery:
    """Append closed song windows to a Parquet folder."""
    return start_append(songs_per_window(song_plays(events)), path, checkpoint, every)


def start_level_summary(
    events: DataFrame,
    checkpoint: str | None = None,
    path: str | None = None,
    every: str | None = fixed.SUMMARY_TRIGGER,
) -> StreamingQuery:
    """Print the running summary, or keep the latest one at ``path``, each as a new version."""
    writer = level_summary(song_plays(events)).writeStream.outputMode("complete")
    if path is None:
        return _start(writer.format("console"), checkpoint, every)

    def replace(latest: DataFrame, batch_id: int) -> None:
        write_version(latest, path)
        tidy(latest.sparkSession, path)

    return _start(writer.foreachBatch(replace), checkpoint, every)


def start_level_sets(
    events: DataFrame, path: str, checkpoint: str, every: str | None = fixed.SUMMARY_TRIGGER
) -> StreamingQuery:
    """Land the users of each micro-batch as sets per level.

    The query keeps no state. A repeated micro-batch overwrites its own folder.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        run = batch.sparkSession.sparkContext.getLocalProperty(QUERY_ID)
        user_sets(batch, "level").write.mode("overwrite").parquet(f"{path}/run={run}/batch_id={batch_id}")

    return _start(song_plays(events).writeStream.foreachBatch(write), checkpoint, every)


def level_users(spark: SparkSession, path: str) -> DataFrame:
    """The running summary of :func:`start_level_sets`: plays and exact users per level so far."""
    return counted(read_view(spark, path), "level", total="plays")


def run_until_stopped(spark: SparkSession, queries: list[StreamingQuery]) -> None:
    """Wait for any query to end, then stop all of them."""
    try:
        spark.streams.awaitAnyTermination()
    finally:
        for query in queries:
            query.stop()
