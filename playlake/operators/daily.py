"""Tables kept by day, so that a batch run only touches the days it has news of.

* ``survivors``: the play that :func:`clean.dedup` keeps for each event, before its event
  time is filled, by ``day``, the UTC day of ``ts``. All copies of an event have the
  same ``ts``, so they meet in one day, and the survivor of survivors and new rows is the
  survivor of all rows.
* ``tracks``, ``hours``: the tallies of :mod:`views` by day. They are finer than tallies
  over everything, and every view takes them as they are.
* ``user_days`` (userId, play_date, plays, day): the dates a user was active.
* ``first_days`` (userId, first_day): the earliest of them, a state that runs merge by ``min``.
* ``retained``: the rows of the retention view by date. An earlier play that arrives
  later makes its user a returning one on the date that was the first until then, so
  that date is counted anew, too.

``day`` is null for events without a time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from playlake.functions.labels import user_type
from playlake.functions.measures import plays, summarise
from playlake.functions.times import from_millis, with_play_date
from playlake.operators import clean

RETAINED_DDL = "user_type STRING, user_count BIGINT, play_count BIGINT, play_date DATE"


def with_day(events: DataFrame) -> DataFrame:
    """Add the UTC day of ``ts``."""
    return events.withColumn("day", F.to_date(from_millis(F.col("ts"))))


def among(column: str, days: list) -> Column:
    """Whether a date is one of some; None stands for no date.

    The dates are constants of the plan, so a scan of a table kept by them lists only
    their folders.
    """
    known = [day for day in days if day is not None]
    found = F.col(column).isin(known) if known else F.lit(False)
    return F.coalesce(found, F.lit(False)) | F.col(column).isNull() if None in days else found


def outside(column: str, days: list) -> Column:
    return ~F.coalesce(among(column, days), F.lit(False))


def survivors(held: DataFrame, fresh: DataFrame) -> DataFrame:
    """Survivors of what is held for some days and of new raw events, laid out by day.

    Rows are dealt by ranges of (day, key), which both the deduplication and files by day
    can use: they are moved and sorted once, in tasks cut for their number.
    """
    columns = [c for c in held.columns if c != "day"]
    new = clean.filter_page(fresh).select(*columns)
    rows = with_day(held.select(*columns).unionByName(new))
    return clean.dedup(rows.repartitionByRange("day", *clean.EVENT_KEY), "day")


def user_days(hours: DataFrame) -> DataFrame:
    """(userId, play_date, day, plays) from hourly tallies by day."""
    known = with_play_date(hours).filter(F.col("userId").isNotNull())
    return summarise(known, ["userId", "play_date", "day"], plays=plays)


def gone_users(before: DataFrame, after: DataFrame) -> DataFrame:
    """Users with a date in ``before`` that ``after`` doesn't have: a survivor with another time took its place."""
    return before.join(after, ["userId", "play_date"], "left_anti").select("userId").distinct()


def first_days(*parts: DataFrame) -> DataFrame:
    """userId -> first_day over tables that hold it or ``play_date``."""
    held = None
    for part in parts:
        column = "first_day" if "first_day" in part.columns else "play_date"
        some = part.select("userId", F.col(column).alias("first_day"))
        held = some if held is None else held.unionByName(some)
    return held.groupBy("userId").agg(F.min("first_day").alias("first_day"))


def moved_dates(before: DataFrame, after: DataFrame) -> DataFrame:
    """Dates on which a user's type changes: the first day before and the one after, where they differ."""
    now = after.select("userId", F.col("first_day").alias("now"))
    changed = before.join(now, "userId").filter(F.col("first_day") != F.col("now"))
    return changed.select(F.explode(F.array("first_day", "now")).alias("play_date")).distinct()


def retained(days: DataFrame, firsts: DataFrame) -> DataFrame:
    """Rows of :func:`views.retention` for the dates in ``days``, first days looked up."""
    per_user = days.groupBy("userId", "play_date").agg(F.sum("plays").alias("plays"))
    typed = per_user.join(firsts, "userId").withColumn("user_type", user_type(F.col("play_date"), F.col("first_day")))
    return summarise(typed, ["play_date", "user_type"], user_count=lambda df: F.count(F.lit(1)), play_count=plays)
