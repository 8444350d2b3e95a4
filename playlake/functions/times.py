"""Event time: epoch milliseconds, hours, days and minutes."""

from pyspark.sql import Column, DataFrame, functions as F

from playlake.functions.numbers import half_up

MS_PER_HOUR = 3_600_000
MS_PER_DAY = 24 * MS_PER_HOUR


def from_millis(ms: Column) -> Column:
    """Timestamp of epoch milliseconds, without going through a double."""
    return F.timestamp_millis(ms)


def utc_hour_key(ms: Column) -> Column:
    """Two-digit UTC hour of epoch milliseconds, whatever the session zone."""
    hour = F.floor(F.pmod(ms, F.lit(MS_PER_DAY)) / MS_PER_HOUR)
    return F.lpad(hour.cast("string"), 2, "0")


def minutes_between(end: Column, start: Column, places: int = 1) -> Column:
    """Minutes between the whole seconds of two timestamps."""
    return half_up((F.unix_timestamp(end) - F.unix_timestamp(start)) / 60, places)


def with_hour_bucket(df: DataFrame) -> DataFrame:
    """Add ``hour_bucket`` unless the frame is already held by hour."""
    if "hour_bucket" in df.columns:
        return df
    return df.withColumn("hour_bucket", F.date_trunc("hour", "event_ts"))


def with_play_date(df: DataFrame) -> DataFrame:
    """Add ``play_date`` from the finest time column present."""
    source = "hour_bucket" if "hour_bucket" in df.columns else "event_ts"
    return df.withColumn("play_date", F.to_date(source))
