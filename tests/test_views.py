from datetime import date, datetime

from pyspark.sql import functions as F

from checks.queries import cleaned, order_clean
from playlake.functions.labels import user_type
from playlake.operators import clean, counts, features, questions, views
from tests.conftest import SMALL, event, plan, rows


def test_overview_of_nothing(plays):
    row = views.overview(plays()).first()
    assert row["total_plays"] == 0 and row["unique_users"] == 0
    assert row["avg_duration_sec"] is None and row["max_duration_sec"] is None


def test_overview_ignores_nulls_in_distincts(plays):
    df = plays(event(), event(userId=None, song=None, duration=None), event(userId=2, song="t"))
    row = views.overview(df).first()
    assert (row["total_plays"], row["unique_users"], row["unique_songs"]) == (3, 2, 2)
    assert row["avg_duration_sec"] == 100.0


def test_null_keys_stay_a_group(plays):
    df = plays(event(artist=None), event(artist=None, userId=None), event())
    assert rows(views.top_artists(df)) == [("A", 1, 1, 1), (None, 2, 1, 1)]
    assert rows(views.top_songs(df)) == [("s", "A", 1, 1, 100.0), ("s", None, 2, 1, 100.0)]


def test_top_ties_are_broken_by_key(plays):
    df = plays(*[event(song=f"s{n:02d}") for n in range(15)])
    assert [r["song"] for r in views.top10_songs(df).collect()] == [f"s{n:02d}" for n in range(10)]


def test_top_locations_keeps_fifteen(plays):
    df = plays(*[event(location=f"C, S{n:02d}") for n in range(20)])
    assert views.top_locations(df).count() == 15


def test_sessions_truncate_to_seconds(plays):
    df = plays(
        event("2024-01-01 23:59:59.900"),
        event("2024-01-02 00:01:05.100"),
        event("2024-01-02 00:01:05.100", sessionId=2, duration=None),
    )
    got = {r["sessionId"]: r for r in views.session_stats(df).collect()}
    assert got[1]["session_duration_min"] == 1.1  # 66 whole seconds, not 65.2
    assert got[1]["session_minutes"] == 3.3
    assert got[2]["session_minutes"] is None
    assert rows(views.session_dist(views.session_stats(df))) == [(1, 1, None), (2, 1, 3.3)]


def test_retention_months_and_null_users(plays):
    df = plays(
        event("2023-12-31 23:59:59.999"),
        event("2024-01-01 00:00:00"),
        event("2024-01-01 12:00:00"),
        event("2024-01-01 00:00:00", userId=2),
        event("2024-01-01 00:00:00", userId=None),
    )
    assert rows(views.retention(df)) == [
        (date(2023, 12, 31), "new", 1, 1),
        (date(2024, 1, 1), "new", 1, 1),
        (date(2024, 1, 1), "returning", 1, 2),
    ]


def test_retention_equals_its_join_form(spark):
    df = cleaned(spark, SMALL).withColumn("play_date", F.to_date("event_ts"))
    first = df.groupBy("userId").agg(F.min("play_date").alias("first"))
    joined = (
        df.join(first, "userId")
        .withColumn("user_type", user_type(F.col("play_date"), F.col("first")))
        .groupBy("play_date", "user_type")
        .agg(F.count_distinct("userId").alias("user_count"), F.count("*").alias("play_count"))
    )
    assert rows(views.retention(df)) == rows(joined)


def test_views_of_a_tally_equal_views_of_events(spark):
    df = order_clean(spark, SMALL)
    tracks, hours = views.listener_tracks(df), views.listener_hours(df)
    for view in (
        views.top_songs, views.top_artists, views.level_stats, views.gender_stats,
        views.level_ratio, views.top_locations,
    ):
        assert rows(view(tracks)) == rows(view(df)), view.__name__
    for view in (views.plays_by_hour, views.active_users_ts, views.first_play, views.retention):
        assert rows(view(hours)) == rows(view(df)), view.__name__


def test_level_ratio_counts_pairs(plays):
    df = plays(event(), event(level="paid"), event(userId=2, level="paid"), event(userId=None))
    got = {r["level"]: r["user_pct"] for r in views.level_ratio(df).collect()}
    assert got == {"free": 25.0, "paid": 50.0}  # (1,free) (null,free) (1,paid) (2,paid)


def test_approximate_listeners_stay_near_the_exact_count(spark):
    df = order_clean(spark, SMALL)
    both = views.approx_listeners(df).join(views.top_songs(df), ["song", "artist"])
    off = F.abs(F.col("approx_listeners") - F.col("unique_listeners"))
    assert both.filter(off > 3 * 0.05 * F.col("unique_listeners") + 1).count() == 0


def test_sketches_are_an_option_of_exact_views(spark):
    df = order_clean(spark, SMALL)
    for view in (views.overview, views.top_songs, views.top_artists):
        exact, sketched = view(df), view(df, approx=True)
        assert sketched.dtypes == exact.dtypes
        assert sketched.count() == exact.count()
        assert plan(sketched).count("FileScan") == 1  # one pass, however many counts
    row, near = views.overview(df).first(), views.overview(df, approx=True).first()
    assert abs(row["unique_users"] - near["unique_users"]) <= 0.15 * row["unique_users"]


def test_keyed_counts_drop_missing_keys(plays):
    df = plays(event(), event(artist=""), event(artist=None, userId=None), event(ts=0), event(None))
    assert rows(counts.count_by_artist_key(df)) == [("A", 3)]
    assert rows(counts.count_by_hour_key(df)) == [("10", 3)]
    assert rows(counts.count_by_user_key(df)) == [("1", 4)]
    assert (None, 1) in rows(counts.bench_top_artists(df))


def test_hour_keys_are_utc_in_any_zone(spark, plays):
    df = plays(event("2024-01-01 23:30:00"))
    spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
    try:
        assert rows(counts.count_by_hour_key(df)) == [("23", 1)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_funnel_keeps_order_and_missing_stages(events):
    df = events(event(page="Home"), event(page="Upgrade"), event(page="Upgrade"), event(page=None))
    assert [tuple(r) for r in questions.funnel(df).collect()] == [
        (1, "Home", 1), (2, "Settings", 0), (3, "Upgrade", 2), (4, "Submit Upgrade", 0),
    ]


def test_premium_ratio(plays):
    df = plays(event(), event(level="paid"), event(userId=2), event(userId=None, level="paid"))
    assert questions.premium_ratio(df).first()[0] == 50.0
    assert questions.premium_ratio(df.limit(0)).first()[0] is None


def test_hour_bucket(plays):
    df = plays(event("2024-01-01 10:59:59.999"), event("2024-01-01 10:00:00"), event("2024-01-01 11:00:00"))
    assert rows(views.active_users_ts(df)) == [
        (datetime(2024, 1, 1, 10), 1, 2), (datetime(2024, 1, 1, 11), 1, 1),
    ]


def test_plans_prune_and_avoid_row_copies(spark):
    df = cleaned(spark, SMALL)
    for view in (views.overview, views.top_artists, views.retention, views.level_ratio):
        text = plan(view(df))
        assert "Expand" not in text and "Python" not in text, view.__name__
    assert "ReadSchema: struct<userId:int,level:string>" in plan(views.distinct_user_levels(df))
    assert "TakeOrderedAndProject" in plan(views.top10_songs(df))
    assert "firstName" not in plan(views.top_songs(df))


def test_every_shuffle_of_events_carries_partial_results(spark):
    """A hot key leaves each task as one row per group, never as its events."""
    df = cleaned(spark, SMALL)
    held = [
        views.overview, views.top_songs, views.top_artists, views.top_locations, views.plays_by_hour,
        views.level_stats, views.gender_stats, views.level_ratio, views.session_stats,
        views.retention, views.active_users_ts, views.first_play, features.user_features,
        features.churn_features, features.churn_labels_time, counts.count_by_artist_key, clean.dedup,
    ]
    for view in held:
        lines = plan(view(df)).splitlines()
        shuffles = [i for i, line in enumerate(lines) if "Exchange hashpartitioning" in line]
        assert shuffles, view.__name__
        for i in shuffles:
            below = lines[i + 1]
            assert "Aggregate" in below or "Union" in below, (view.__name__, below)
