"""Per-user features, churn labels and the training table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from playlake import fixed
from playlake.functions.labels import low_engagement
from playlake.functions.measures import (
    Measure,
    combine,
    distinct,
    last_seen,
    mean_seconds,
    plays,
    summarise,
)
from playlake.functions.numbers import half_up
from playlake.functions.times import with_play_date
from playlake.operators.clean import cutoff, time_split

SKETCH_SIZE = 4096  # an error of about 0.1 % in rank; a sketch has at most some 100 KB

HABIT_COLUMNS = [
    "total_plays",
    "unique_artists",
    "unique_songs",
    "total_sessions",
    "avg_duration",
    "active_days",
]


def latest_level(facts: DataFrame) -> DataFrame:
    """userId -> level of the user's last event."""
    held = facts.groupBy("userId", "level").agg(last_seen(facts).alias("last_seen"))
    last = F.max_by("level", F.struct("last_seen", "level"))
    return held.groupBy("userId").agg(last.alias("level"))


def _habits(events: DataFrame, **more: Measure) -> DataFrame:
    """userId -> habits, ``more`` and the latest level.

    The level is text, which an aggregation can only hold by sorting; it joins
    the other parts once those are down to one row per user.
    """
    days = with_play_date(events)
    counted = summarise(
        days,
        ["userId"],
        total_plays=plays,
        unique_artists=distinct("artist"),
        unique_songs=distinct("song"),
        total_sessions=distinct("sessionId"),
        avg_duration=mean_seconds,
        active_days=distinct("play_date"),
        **more,
    )
    return combine(["userId"], [counted, latest_level(events)])


def user_features(events: DataFrame) -> DataFrame:
    """Listening habits per user, for segmentation."""
    return _habits(events)


def user_features_of_tables(tracks: DataFrame, hours: DataFrame, sessions: DataFrame) -> DataFrame:
    """:func:`user_features` from the tables a batch run already holds.

    Sessions are one row per (user, session) there, so counting them needs no
    distinct; the other counts run over tallies instead of events.
    """
    heard = summarise(
        tracks,
        ["userId"],
        total_plays=plays,
        unique_artists=distinct("artist"),
        unique_songs=distinct("song"),
        avg_duration=mean_seconds,
    )
    visits = sessions.groupBy("userId").agg(F.count("sessionId").alias("total_sessions"))
    days = summarise(with_play_date(hours), ["userId"], active_days=distinct("play_date"))
    whole = combine(["userId"], [heard, visits, days, latest_level(tracks)])
    return whole.select("userId", *HABIT_COLUMNS, "level")


def churn_features(events: DataFrame) -> DataFrame:
    """Habits in the early period, with the span and rate of listening."""
    early, _ = time_split(events)
    span = F.date_diff(F.max("event_ts"), F.min("event_ts"))
    daily = half_up(F.col("total_plays") / (F.col("days_span") + 1), 2)
    return _habits(early, days_span=lambda df: span).withColumn("plays_per_day", daily)


def early_users(events: DataFrame) -> DataFrame:
    return time_split(events)[0].select("userId").distinct()


def late_users(events: DataFrame) -> DataFrame:
    return time_split(events)[1].select("userId").distinct()


def churned_users(events: DataFrame) -> DataFrame:
    """Users of the early period who are gone in the late one."""
    return early_users(events).join(late_users(events), "userId", "left_anti")


def retained_users(events: DataFrame) -> DataFrame:
    return early_users(events).join(late_users(events), "userId", "left_semi")


def churn_labels_time(events: DataFrame) -> DataFrame:
    """userId -> label: 1 if active early and not late.

    Same rows as churned (1) plus retained (0) users, from one aggregation over
    two columns instead of two distincts, two joins and a union.
    """
    end = cutoff(events)
    span = (
        events.filter(F.col("userId").isNotNull())
        .groupBy("userId")
        .agg(F.min("event_ts").alias("first_event"), F.max("event_ts").alias("last_event"))
    )
    return span.filter(F.col("first_event") <= end).select(
        "userId", (F.col("last_event") <= end).cast("int").alias("label")
    )


def quartile(column: str) -> Column:
    """Approximate lower quartile of a column (one sketch, merged once)."""
    return F.percentile_approx(column, fixed.QUARTILE, 10000)


def engagement_quartiles(features: DataFrame) -> DataFrame:
    return features.agg(
        quartile("plays_per_day").alias("plays_per_day_q25"),
        quartile("active_days").alias("active_days_q25"),
    )


def engagement_sketches(features: DataFrame, *by: str) -> DataFrame:
    """(by, plays_per_day, active_days): quantile sketches of the users of each group.

    Sketches of any groups are merged by :func:`sketched_quartiles`. Stored by group (a
    signup month, a file of users, a run) they give the bars of all users without
    another look at the features, and a group that changed is sketched anew by itself.
    """
    return features.groupBy(*by).agg(
        F.kll_sketch_agg_double(F.col("plays_per_day").cast("double"), F.lit(SKETCH_SIZE)).alias("plays_per_day"),
        F.kll_sketch_agg_double(F.col("active_days").cast("double"), F.lit(SKETCH_SIZE)).alias("active_days"),
    )


def sketched_quartiles(sketches: DataFrame, share: float = fixed.QUARTILE) -> DataFrame:
    """:func:`engagement_quartiles` of all sketched users; ranks are off by about 0.1 %.

    Up to SKETCH_SIZE users the sketch holds every value, and the bars are those of all values.
    """

    def bar(column: str) -> Column:
        merged = F.kll_merge_agg_double(column, F.lit(SKETCH_SIZE))
        some = F.kll_sketch_get_n_double(merged) > 0
        return F.when(some, F.kll_sketch_get_quantile_double(merged, F.lit(share)))

    return sketches.agg(
        bar("plays_per_day").alias("plays_per_day_q25"), bar("active_days").cast("bigint").alias("active_days_q25")
    )


def engagement_label(features: DataFrame, bars: DataFrame | None = None) -> Column:
    """1 for a user in the lowest quarter by rate and by active days.

    Both bars come from one scalar subquery over ``features``, or over ``bars`` if given
    (those of :func:`sketched_quartiles`, say).
    """
    bars = engagement_quartiles(features) if bars is None else bars
    return low_engagement(
        F.col("plays_per_day"),
        F.col("active_days"),
        bars.select("plays_per_day_q25").scalar(),
        bars.select("active_days_q25").scalar(),
    )


def churn_labels_engagement(features: DataFrame, bars: DataFrame | None = None) -> DataFrame:
    known = features.filter(F.col("userId").isNotNull())
    return known.select("userId", engagement_label(features, bars).alias("label"))


def churn_rate(labels: DataFrame) -> DataFrame:
    return labels.agg(F.avg("label").alias("churn_rate"))


def churn_dataset(features: DataFrame, time_labels: DataFrame) -> DataFrame:
    """Features with the label to train on; missing numbers become 0.

    Time labels are used unless they mark fewer than 5 % of the users, then the
    engagement labels. The choice is a scalar subquery, so the plan stays lazy;
    ``label_kind`` records it.
    """
    labelled = features.join(time_labels.withColumnRenamed("label", "time_label"), "userId")
    rate = churn_rate(labelled.select(F.col("time_label").alias("label"))).scalar()
    by_time = rate >= fixed.LOW_CHURN_RATE
    return (
        labelled.withColumn("label", F.when(by_time, F.col("time_label")).otherwise(engagement_label(features)))
        .withColumn("label_kind", F.when(by_time, "time").otherwise("engagement"))
        .drop("time_label")
        .na.fill(0)
    )
