"""The questions a business dashboard asks of the views."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from playlake import fixed
from playlake.functions.numbers import percent


def premium_ratio(events: DataFrame) -> DataFrame:
    """Users who ever paid, in percent of all users, from one pass over (user, level)."""
    paying = F.max((F.col("level") == "paid").cast("int")).alias("paying")
    per_user = events.filter(F.col("userId").isNotNull()).groupBy("userId").agg(paying)
    share = percent(F.count_if(F.col("paying") == 1), F.count(F.lit(1)))
    return per_user.agg(share.alias("premium_pct"))


def kpi_summary(overview: DataFrame, summary: DataFrame, events: DataFrame) -> DataFrame:
    """One row: total streams, active users, premium share and last sync."""
    return summary.select(
        (F.col("batch_total") + F.col("stream_total")).alias("total_streams"),
        overview.select("unique_users").scalar().alias("active_users"),
        premium_ratio(events).scalar().alias("premium_pct"),
        F.substring("latest_ingestion", 1, 16).alias("last_sync"),
    )


def churn_kpi(churn_summary: DataFrame) -> DataFrame:
    return churn_summary.select(F.col("avg_churn_pct").alias("churn_risk_pct"))


def funnel(raw: DataFrame) -> DataFrame:
    """Events per upgrade stage, in stage order; 0 for a stage never seen.

    One pass with a counter per stage; each task sends a single row.
    """
    counters = [
        F.count_if(F.col("page") == stage).alias(f"stage{n}")
        for n, stage in enumerate(fixed.FUNNEL_STAGES)
    ]
    rows = [
        F.struct(
            F.lit(n + 1).alias("step"),
            F.lit(stage).alias("stage"),
            F.col(f"stage{n}").alias("event_count"),
        )
        for n, stage in enumerate(fixed.FUNNEL_STAGES)
    ]
    return raw.agg(*counters).select(F.inline(F.array(*rows)))


def users_per_segment(profiles: DataFrame) -> DataFrame:
    return profiles.select("segment_label", "user_count")


def latest_names(events: DataFrame, users: DataFrame) -> DataFrame:
    """Latest name of each of a few ``users``."""
    seen = events.select("userId", "firstName", "lastName", "event_ts")
    newest = F.max(F.struct("event_ts", "firstName", "lastName")).alias("newest")
    return (
        seen.join(users.select("userId"), "userId", "left_semi")
        .groupBy("userId")
        .agg(newest)
        .select("userId", "newest.firstName", "newest.lastName")
    )


def at_risk_users(predictions: DataFrame, events: DataFrame, rows: int = fixed.AT_RISK_ROWS) -> DataFrame:
    """Paying users at high risk, most endangered first, with their names.

    The top rows are chosen before names are looked up, so events are reduced
    to a handful of users by a semi join ahead of any shuffle.
    """
    endangered = predictions.filter((F.col("level") == "paid") & (F.col("risk_level") == "High"))
    worst = endangered.orderBy(F.desc("churn_probability"), "userId").limit(rows)
    return worst.join(latest_names(events, worst), "userId", "left").select(
        "userId", "firstName", "lastName", "risk_level", "churn_probability"
    )


def top_artist(top_artists: DataFrame) -> DataFrame:
    """The artist tile: the most played one."""
    return top_artists.orderBy(F.desc("play_count"), "artist").limit(1)


def hourly_by_layer(batch_hours: DataFrame, speed_hours: DataFrame) -> DataFrame:
    """Both timelines side by side, tagged with their layer."""
    return batch_hours.withColumn("layer", F.lit("batch")).unionByName(
        speed_hours.withColumn("layer", F.lit("speed"))
    )
