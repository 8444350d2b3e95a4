"""Sets of users: merged and rolled up they count as a distinct over all events would."""

import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from playlake.operators import audience
from tests.conftest import event, plan, rows


def at(hour: int, minute: int = 0, day: int = 1) -> str:
    return f"2024-01-{day:02d} {hour:02d}:{minute:02d}:00"


@pytest.fixture(scope="module")
def many(plays):
    """Two layers of plays; ids around the edges of a bitmap, null and negative ids too."""
    rng = random.Random(8)
    ids = [None, 0, -1, -40_000, 1, 32_768, 32_769, 65_536, 2**31 - 1, *range(100, 140)]
    layers = []
    for _ in range(2):
        drawn = [
            event(at(rng.randrange(24), rng.randrange(60), rng.randrange(1, 4)), userId=rng.choice(ids), song=rng.choice("abc"))
            for _ in range(400)
        ]
        layers.append(plays(*drawn))
    return layers


def want(both, *keys):
    return rows(both.groupBy(*keys).agg(F.count_distinct("userId"), F.count(F.lit(1))))


def test_merged_hours_count_a_user_of_both_layers_once(many):
    batch, speed = many
    both = batch.unionByName(speed)
    got = audience.merged_active_users(audience.hour_users(batch), audience.hour_users(speed))
    assert rows(got) == want(both.withColumn("h", F.date_trunc("hour", "event_ts")), "h")


def test_songs_and_coarser_periods_without_events(spark, many, tmp_path):
    batch, speed = many
    both = batch.unionByName(speed)
    got = audience.merged_listeners(audience.song_users(batch), audience.song_users(speed))
    assert rows(got) == want(both, "song", "artist")
    audience.merged(audience.hour_users(batch), audience.hour_users(speed)).write.parquet(str(tmp_path / "hours"))
    hours = spark.read.parquet(str(tmp_path / "hours"))
    for unit in ("day", "week", "month"):
        got = audience.active_users_per(hours, unit)
        assert rows(got) == want(both.withColumn("p", F.date_trunc(unit, "event_ts")), "p")
        assert "userId" not in plan(got)


def test_sets_of_a_tally_equal_those_of_events(many):
    from playlake.operators import views

    batch, _ = many
    tallied = audience.hour_users(views.listener_hours(batch))
    assert rows(audience.counted(tallied, "hour_bucket")) == rows(audience.counted(audience.hour_users(batch), "hour_bucket"))


def test_arrival_hours_and_null_users(plays):
    late = plays(
        event(at(10), ingestion_time="2024-01-01 12:00:01"),
        event(at(11), ingestion_time="2024-01-01 12:59:59"),
        event(at(11), userId=None, ingestion_time="2024-01-01 13:00:00"),
    )
    got = audience.counted(audience.hour_users(late, "ingestion_time"), "hour_bucket")
    assert rows(got) == [(datetime(2024, 1, 1, 12), 1, 2), (datetime(2024, 1, 1, 13), 0, 1)]


def test_empty_layers(plays):
    none, one = plays(), plays(event(at(10)))
    assert rows(audience.merged_active_users(audience.hour_users(none), audience.hour_users(none))) == []
    got = audience.merged_active_users(audience.hour_users(none), audience.hour_users(one))
    assert rows(got) == [(datetime(2024, 1, 1, 10), 1, 1)]
    assert rows(audience.stickiness(audience.hour_users(none))) == []


def test_stickiness(plays):
    held = plays(*[event(at(10, day=d), userId=u) for d, u in [(1, 1), (1, 2), (1, 2), (2, 1), (3, 1), (3, 3)]])
    got = audience.stickiness(audience.hour_users(held))
    assert rows(got) == [(datetime(2024, 1, 1), 3, 3, 1.67, 55.56)]


def test_sketches_merge_with_little_error(spark):
    facts = spark.range(90_000).select(
        (F.col("id") % 2).alias("song"), (F.col("id") % 30_000).cast("int").alias("userId"), (F.col("id") % 7).alias("part")
    )
    parts = [audience.listener_sketches(facts.filter(F.col("part") == n), "song") for n in range(7)]
    got = audience.estimated(audience.merged(*parts), "song").collect()
    assert {r.play_count for r in got} == {45_000}
    assert all(abs(r.approx_listeners - 15_000) < 0.05 * 15_000 for r in got)
