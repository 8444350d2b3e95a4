from datetime import datetime

from pyspark.sql import functions as F

from playlake.operators import merge, views
from tests.conftest import event, plan, rows

AT = "2024-01-01 10:00:00"


def test_full_outer_merge(plays):
    batch = plays(event(), event(userId=2), event(song="only batch"), event(artist=None))
    speed = plays(event(), event(song="only speed"), event(artist=None))
    got = merge.merged_top_songs(views.top_songs(batch), merge.speed_top_songs(speed))
    assert rows(got) == sorted(
        [
            ("s", "A", 2, 2, 100.0, 1, 1, 3),
            ("only batch", "A", 1, 1, 100.0, 0, 0, 1),
            ("only speed", "A", 0, 0, None, 1, 1, 1),
            ("s", None, 1, 1, 100.0, 0, 0, 1),  # null keys never meet
            ("s", None, 0, 0, None, 1, 1, 1),
        ],
        key=repr,
    )


def test_merged_artists_keep_songs_null_on_speed_only(plays):
    got = merge.merged_top_artists(
        views.top_artists(plays(event())), merge.speed_top_artists(plays(event(artist="B")))
    )
    assert rows(got) == [("A", 1, 1, 1, 0, 0, 1), ("B", 0, 0, None, 1, 1, 1)]


def test_merge_without_speed_or_batch(plays):
    songs = views.top_songs(plays(event()))
    none = merge.speed_top_songs(plays())
    assert rows(merge.merged_top_songs(songs, none)) == [("s", "A", 1, 1, 100.0, 0, 0, 1)]
    empty = views.top_songs(plays())
    only = merge.speed_top_songs(plays(event()))
    assert rows(merge.merged_top_songs(empty, only)) == [("s", "A", 0, 0, None, 1, 1, 1)]


def test_timeline_sums_users_of_both_layers(plays):
    batch = views.active_users_ts(plays(event(AT)))
    speed = merge.speed_active_ts(plays(event(AT, ingestion_time="2024-01-01 10:00:02")))
    assert rows(merge.merged_active_ts(batch, speed)) == [(datetime(2024, 1, 1, 10), 2, 2)]


def test_speed_hours_use_arrival_time(plays):
    df = plays(event("2024-01-01 10:59:59", ingestion_time="2024-01-01 11:00:01"))
    assert rows(merge.speed_active_ts(df), "hour_bucket") == [(datetime(2024, 1, 1, 11),)]
    assert rows(merge.speed_active_ts(df, "event_ts"), "hour_bucket") == [(datetime(2024, 1, 1, 10),)]


def test_summary_without_speed(plays):
    assert rows(merge.speed_summary(plays(event()), plays())) == [(0, 1, "N/A")]


def test_speed_after_goes_by_landing_not_by_event_time(plays):
    def landed(run, batch_id, *times):
        some = plays(*[event(t) for t in times])
        return some.withColumn("run", F.lit(run)).withColumn("batch_id", F.lit(batch_id))

    seen = landed("a", 0, AT, "2099-01-01 00:00:00").union(landed("a", 1, AT))
    mark = merge.landed_until(seen)
    assert rows(mark) == [("a", 1)]
    late, future = "2020-01-01 00:00:00", "2098-01-01 00:00:00"
    fresh = landed("a", 2, late, future, None).union(landed("b", 0, AT)).union(landed(None, None, AT))
    assert merge.speed_after(mark, seen.union(fresh)).count() == fresh.count()
    assert merge.speed_after(mark.limit(0), seen.union(fresh)).count() == 8


def test_merged_events_filter_is_on_the_batch_side(plays):
    batch, speed = plays(event(), event(page="Home")), plays(event(page="Home"))
    assert rows(merge.records_by_source(merge.merged_events(batch, speed))) == [("batch", 1), ("stream", 1)]
    every = merge.merged_events(batch, speed, filter_batch=False)
    assert rows(merge.records_by_source(every)) == [("batch", 2), ("stream", 1)]


def test_live_feed_is_the_newest_ten(plays):
    df = plays(*[event(song=f"s{n}", ingestion_time=f"2024-01-01 10:00:{n:02d}") for n in range(15)])
    feed = merge.live_feed(df)
    assert [r["song"] for r in feed.collect()] == [f"s{n}" for n in range(14, 4, -1)]
    assert "TakeOrderedAndProject" in plan(feed)
