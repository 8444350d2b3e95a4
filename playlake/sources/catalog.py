"""Catalog objects: a database with event tables, view tables and a merged view.

Everything is a Spark data source table (``USING parquet``), so it works with
the built-in catalog and with a metastore alike.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from playlake import fixed
from playlake.functions.measures import distinct, hours_played, mean_seconds, plays, summarise
from playlake.functions.times import from_millis
from playlake.operators import merge, views
from playlake.operators.clean import filter_page
from playlake.schema import EVENT_COLUMNS, EVENT_DDL, PAYLOAD_COLUMNS

BATCH_TABLE = "play_events"
SPEED_TABLE = "streaming_events"
MERGED_VIEW = "merged_events"

_SECONDS = "round(round(avg(duration), 9), 1) AS avg_duration_sec"

# The view tables as SQL text, over any event table of a catalog.
SQL_TEXTS = {
    "top_songs": f"""
        SELECT song, artist, count(*) AS play_count, count(DISTINCT userId) AS unique_listeners, {_SECONDS}
        FROM {{events}} GROUP BY song, artist
        ORDER BY play_count DESC, song, artist LIMIT {fixed.TOP_SQL}""",
    "top_artists": f"""
        SELECT artist, count(*) AS play_count, count(DISTINCT userId) AS unique_listeners,
               count(DISTINCT song) AS unique_songs
        FROM {{events}} GROUP BY artist ORDER BY play_count DESC, artist LIMIT {fixed.TOP_SQL}""",
    "plays_by_hour": f"""
        SELECT hour(event_ts) AS hour_of_day, count(*) AS play_count,
               count(DISTINCT userId) AS active_users, {_SECONDS}
        FROM {{events}} GROUP BY hour(event_ts)""",
    "level_stats": f"""
        SELECT level, count(*) AS play_count, count(DISTINCT userId) AS user_count, {_SECONDS},
               round(round(sum(duration) / 3600, 9), 2) AS total_hours_played
        FROM {{events}} GROUP BY level""",
}


BUCKETS = 64


class Catalog:
    """One database of play-event tables."""

    def __init__(self, spark: SparkSession, database: str, location: str | None = None):
        self.spark = spark
        self.database = database
        where = f" LOCATION '{location}'" if location else ""
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}{where}")

    def name(self, table: str) -> str:
        return f"{self.database}.{table}"

    def table(self, table: str) -> DataFrame:
        return self.spark.table(self.name(table))

    def use(self) -> None:
        self.spark.sql(f"USE {self.database}")

    def external(self, table: str, path: str, folders: str | None = None) -> DataFrame:
        """(Re)declare an event table over existing files; the files stay put.

        ``folders`` names the layout's folder columns with their types, such as
        ``batch_id BIGINT`` for a stream's output.
        """
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name(table)}")
        self.spark.sql(
            f"CREATE TABLE {self.name(table)} ({EVENT_DDL}{', ' + folders if folders else ''}) "
            f"USING parquet{self._by(folders)} LOCATION '{path}'"
        )
        if folders:
            self.spark.sql(f"MSCK REPAIR TABLE {self.name(table)}")
        return self.table(table).select(*EVENT_COLUMNS)

    @staticmethod
    def _by(folders: str | None) -> str:
        if not folders:
            return ""
        names = ", ".join(column.split()[0] for column in folders.split(","))
        return f" PARTITIONED BY ({names})"

    def store(self, table: str, df: DataFrame) -> DataFrame:
        """Create or replace a managed table with the rows of ``df``."""
        df.write.mode("overwrite").format("parquet").saveAsTable(self.name(table))
        return self.table(table)

    def store_bucketed(self, table: str, df: DataFrame, *keys: str, buckets: int = BUCKETS) -> DataFrame:
        """Create or replace a managed table whose rows lie in buckets of ``keys``, sorted.

        Two tables of the same keys and number of buckets are joined and grouped by them
        without a shuffle. Each bucket is one task then, so take a number for the cluster,
        the same for all tables, and keys with about one row each: a hot key would fill its
        bucket.
        """
        spread = df.repartition(buckets, *keys)
        writer = spread.write.mode("overwrite").format("parquet").bucketBy(buckets, *keys).sortBy(*keys)
        writer.saveAsTable(self.name(table))
        return self.table(table)

    def play_events(self, path: str) -> DataFrame:
        return self.external(BATCH_TABLE, path)

    def streaming_events(self, path: str, folders: str | None = None) -> DataFrame:
        return self.external(SPEED_TABLE, path, folders)

    def top_songs(self) -> DataFrame:
        songs = views.top_songs(self.table(BATCH_TABLE))
        return self.store(
            "top_songs", views.top(songs, "play_count", fixed.TOP_SQL, "song", "artist")
        )

    def top_artists(self) -> DataFrame:
        artists = views.top_artists(self.table(BATCH_TABLE))
        return self.store(
            "top_artists", views.top(artists, "play_count", fixed.TOP_SQL, "artist")
        )

    def plays_by_hour(self) -> DataFrame:
        return self.store("plays_by_hour", views.plays_by_hour(self.table(BATCH_TABLE)))

    def level_stats(self) -> DataFrame:
        levels = summarise(
            self.table(BATCH_TABLE),
            ["level"],
            play_count=plays,
            user_count=distinct("userId"),
            avg_duration_sec=mean_seconds,
            total_hours_played=hours_played,
        )
        return self.store("level_stats", levels)

    def sql_text(self, name: str) -> DataFrame:
        """One of ``SQL_TEXTS`` over the batch table, unstored."""
        return self.spark.sql(SQL_TEXTS[name].format(events=self.name(BATCH_TABLE)))

    def merged_events(self, filter_batch: bool = True) -> DataFrame:
        """A persistent view over both event tables; the script form keeps every batch page."""
        payload = ", ".join(PAYLOAD_COLUMNS)
        only_plays = f" WHERE page = '{fixed.PLAY_PAGE}'" if filter_batch else ""
        self.spark.sql(
            f"CREATE OR REPLACE VIEW {self.name(MERGED_VIEW)} AS "
            f"SELECT {payload}, 'batch' AS data_source FROM {self.name(BATCH_TABLE)}{only_plays} "
            f"UNION ALL "
            f"SELECT {payload}, 'stream' AS data_source FROM {self.name(SPEED_TABLE)}"
        )
        return self.table(MERGED_VIEW)

    def merged_songs(self) -> DataFrame:
        ranked = views.top(
            merge.songs_by_source(self.table(MERGED_VIEW)),
            "play_count",
            fixed.TOP_SQL_MERGED,
            "song",
            "artist",
            "data_source",
        )
        return self.store("merged_top_songs", ranked)

    def merged_artists(self) -> DataFrame:
        ranked = views.top(
            merge.artists_by_source(self.table(MERGED_VIEW)),
            "play_count",
            fixed.TOP_SQL_MERGED,
            "artist",
            "data_source",
        )
        return self.store("merged_top_artists", ranked)

    def preview(self, table: str, rows: int = fixed.TOP_VIEW) -> DataFrame:
        return self.table(table).limit(rows)


# The hand-run script's forms of the tables read raw events of every page.


def script_top_songs(raw: DataFrame) -> DataFrame:
    songs = summarise(
        filter_page(raw), ["song", "artist"], play_count=plays, avg_duration_sec=mean_seconds
    )
    return views.top(songs, "play_count", fixed.TOP_SQL, "song", "artist")


def script_top_artists(raw: DataFrame) -> DataFrame:
    artists = summarise(
        filter_page(raw), ["artist"], play_count=plays, unique_listeners=distinct("userId")
    )
    return views.top(artists, "play_count", fixed.TOP_SQL, "artist")


def script_plays_by_hour(raw: DataFrame) -> DataFrame:
    timed = filter_page(raw).withColumn("hour_of_day", F.hour(from_millis(F.col("ts"))))
    return summarise(timed, ["hour_of_day"], play_count=plays, active_users=distinct("userId"))


def script_level_stats(raw: DataFrame) -> DataFrame:
    return views.level_stats(filter_page(raw))
