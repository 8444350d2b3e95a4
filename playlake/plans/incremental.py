"""The batch run by day: what landed since the last one changes its own days only.

Everything a run will write is worked out and staged first; then the days are swapped in,
one table after the other, and the mark of what was read moves last. A run that is lost
on the way is simply run again: merging the same rows twice changes nothing, and the tables
that tell what changed (``user_days``, then the mark) are the last to be swapped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from playlake.operators import clean, daily, merge, views
from playlake.schema import EVENT_COLUMNS, EVENT_DDL
from playlake.session import STORED_WIDENED, fresh_dir, prepare, size_for
from playlake.sources import versions
from playlake.sources.files import read_landed, require_events, stored_bytes

SURVIVORS = f"{EVENT_DDL}, day DATE"
TRACKS = (
    "userId INT, level STRING, gender STRING, location STRING, artist STRING, song STRING, "
    "plays BIGINT, seconds DOUBLE, timed BIGINT, last_seen TIMESTAMP, day DATE"
)
HOURS = "userId INT, hour_bucket TIMESTAMP, plays BIGINT, seconds DOUBLE, timed BIGINT, day DATE"
USER_DAYS = "userId INT, play_date DATE, plays BIGINT, day DATE"
FIRST_DAYS = "userId INT, first_day DATE"
MARK = "run STRING, last_batch BIGINT"
NO_DAY = "__HIVE_DEFAULT_PARTITION__"  # Spark's folder of a null


class DayStore:
    """The tables by day below a folder; those not yet written are empty."""

    def __init__(self, spark: SparkSession, store: str):
        self.spark, self.store = spark, store

    def _read(self, name: str, ddl: str, versioned: bool = False) -> DataFrame:
        path = f"{self.store}/{name}"
        found = versions.current(self.spark, path) if versioned else path if versions.exists(self.spark, path) else None
        if found is None:
            return self.spark.createDataFrame([], ddl)
        return self.spark.read.schema(ddl).parquet(found)

    def survivors(self) -> DataFrame:
        return self._read("survivors", SURVIVORS)

    def clean(self) -> DataFrame:
        """All clean events."""
        return clean.fill_event_time(self.survivors().select(*EVENT_COLUMNS))

    def tracks(self) -> DataFrame:
        return self._read("tracks", TRACKS)

    def hours(self) -> DataFrame:
        return self._read("hours", HOURS)

    def user_days(self) -> DataFrame:
        return self._read("user_days", USER_DAYS)

    def first_days(self) -> DataFrame:
        return self._read("first_days", FIRST_DAYS, versioned=True)

    def retention(self) -> DataFrame:
        return self._read("retained", daily.RETAINED_DDL).filter("user_type is not null")

    def held_bytes(self, name: str, days: list) -> int:
        """Bytes of the files of some days."""
        folders = [f"day={NO_DAY if day is None else day}" for day in days]
        return sum(versions.size(self.spark, f"{self.store}/{name}/{folder}") for folder in folders)

    def mark(self) -> DataFrame:
        return self._read("landed_until", MARK, versioned=True)

    def swap(self, name: str, staged: str) -> None:
        """Replace the days that a staged folder holds by its files; all other days stay as they are.

        The files are moved, not written again. A day's old files go after the new ones came,
        so a run that is lost in between leaves rows twice, which merging again mends, but loses none.
        """
        versions.replace_folders(self.spark, staged, f"{self.store}/{name}")


def _since(mark: DataFrame) -> Column:
    """Condition on (run, batch_id): landed after the mark. It prunes folders, one constant per stream."""
    known = F.lit(False)
    news = F.lit(True)
    for row in mark.collect():  # one row per stream
        mine = F.col("run") == row["run"]
        known = known | mine
        news = news & (~mine | (F.col("batch_id") > row["last_batch"]))
    return F.coalesce(F.when(known, news).otherwise(True), F.lit(True))


def run_incremental(spark: SparkSession, raw_path: str, store: str) -> dict[str, int]:
    """Bring the tables by day up to what has landed; returns how much was new and touched."""
    prepare(spark)
    require_events(spark, raw_path)
    days = DayStore(spark, store)

    paths: dict[str, str] = {}

    def staged(name: str, rows: DataFrame, by: str | None = None) -> DataFrame:
        paths[name] = fresh_dir(spark, f"incremental-{name}")
        writer = rows.write if by is None else rows.write.partitionBy(by)
        writer.parquet(paths[name])
        return spark.read.schema(rows.schema).parquet(paths[name])

    def by_day(name: str, rows: DataFrame, by: str = "day") -> DataFrame:
        return staged(name, rows.hint("rebalance", by), by)

    landed = read_landed(spark, raw_path)  # one listing for the rows and the mark
    fresh = staged("fresh", daily.with_day(clean.filter_page(landed.filter(_since(days.mark())))))
    touched = [row["day"] for row in fresh.select("day").distinct().collect()]  # calendar days
    mark = merge.landed_until(landed)
    if not touched:
        versions.write_version(mark, f"{store}/landed_until")
        return {"new_plays": 0, "touched_days": 0, "recounted_days": 0}

    merging = stored_bytes(spark, paths["fresh"]) + days.held_bytes("survivors", touched)
    size_for(spark, merging, STORED_WIDENED)
    held = days.survivors().filter(daily.among("day", touched))
    survivors = staged("survivors", daily.survivors(held, fresh.select(*EVENT_COLUMNS)), "day")
    plays = clean.fill_event_time(survivors)
    by_day("tracks", views.listener_tracks(plays, "day"))
    hours = by_day("hours", views.listener_hours(plays, "day"))
    now = by_day("user_days", daily.user_days(hours))

    before = days.user_days().filter(daily.among("day", touched))
    others = days.user_days().filter(daily.outside("day", touched))
    known = days.first_days()
    gone = staged("gone", daily.gone_users(before, now))
    if gone.isEmpty():
        firsts = daily.first_days(known, now)
    else:
        again = others.join(gone, "userId", "left_semi")
        firsts = daily.first_days(known.join(gone, "userId", "left_anti"), again, now)
    firsts = staged("first-days", firsts)
    changed = before.select("play_date").union(now.select("play_date")).union(daily.moved_dates(known, firsts))
    dates = [row["play_date"] for row in changed.distinct().collect()]
    counted = daily.retained(
        others.unionByName(now).filter(daily.among("play_date", dates)), firsts
    )
    # A date that lost all its plays gets a row without a type, so that its old rows go.
    empty = spark.createDataFrame([(None, 0, 0, date) for date in dates], daily.RETAINED_DDL)
    by_day("retained", counted.unionByName(empty.select(*counted.columns)), "play_date")

    new_plays = fresh.count()
    for name in ("survivors", "tracks", "hours", "retained"):
        days.swap(name, paths[name])
    versions.write_version(firsts, f"{store}/first_days")
    days.swap("user_days", paths["user_days"])
    versions.write_version(mark, f"{store}/landed_until")
    return {"new_plays": new_plays, "touched_days": len(touched), "recounted_days": len(dates)}
