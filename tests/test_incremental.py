"""The run by day: after any landings its tables equal a full rebuild, and other days' files stay."""

import itertools
import random
from pathlib import Path

import pytest

from playlake.operators import clean, daily, views
from playlake.plans import incremental
from playlake.plans.incremental import DayStore, run_incremental
from playlake.sources import files
from playlake.sources import versions
from tests.conftest import event, plan, rows


def moment(rng, days=(1, 2, 3, 4)):
    return f"2024-01-{rng.choice(days):02d} {rng.randrange(24):02d}:{rng.randrange(60):02d}:00"


def some_events(seed: int, count: int = 50):
    rng = random.Random(seed)
    drawn = [
        event(
            moment(rng), userId=rng.choice([None, *range(1, 9)]), sessionId=rng.randrange(2), song=rng.choice("abc"),
            page=rng.choice(["NextSong", "NextSong", "NextSong", "Home"]), kafka_timestamp=moment(rng, (5, 6)),
        )
        for _ in range(count)
    ]
    copies = [{**e, "kafka_timestamp": moment(rng, (4, 7)), "song": rng.choice("abcd")} for e in rng.sample(drawn, 20)]
    return [*drawn, *copies, event(None, userId=3), event(None, userId=3)]


def land(events, base, number, rows_):
    files.write_parquet(events(*rows_), f"{base}/raw/run=a/batch_id={number}")


def check(spark, base):
    """All tables by day against a rebuild from all raw events."""
    days = DayStore(spark, f"{base}/days")
    held = clean.clean_events(files.read_events(spark, f"{base}/raw"))
    assert rows(days.clean(), *held.columns) == rows(held)
    assert rows(views.top_songs(days.tracks())) == rows(views.top_songs(held))
    assert rows(views.listener_tracks(days.tracks())) == rows(views.listener_tracks(held))
    assert rows(views.active_users_ts(days.hours())) == rows(views.active_users_ts(held))
    assert rows(days.retention(), *views.retention(held).columns) == rows(views.retention(held))
    assert rows(days.first_days()) == rows(views.first_play(held).filter("userId is not null"))


@pytest.mark.parametrize("order", [(0, 1, 2), (2, 0, 1)])
def test_three_landings_in_any_order(spark, events, tmp_path, order):
    drawn = some_events(7)
    random.Random(1).shuffle(drawn)
    parts = [drawn[n::3] for n in range(3)]
    for number, part in enumerate(order):
        land(events, tmp_path, number, parts[part])
        done = run_incremental(spark, f"{tmp_path}/raw", f"{tmp_path}/days")
        assert done["touched_days"] in (4, 5) and done["new_plays"] > 0  # with and without plays that have no time
        if order[0] == 0 or number == 2:
            check(spark, tmp_path)
    assert run_incremental(spark, f"{tmp_path}/raw", f"{tmp_path}/days") == {
        "new_plays": 0, "touched_days": 0, "recounted_days": 0,
    }


def day_files(base):
    found = {}
    for path in Path(f"{base}/days").rglob("*.parquet"):
        if "day=" in str(path.parent):
            found.setdefault(path.parent.name, {})[str(path)] = path.stat().st_mtime_ns
    return found


def test_only_days_with_news_are_written(spark, events, tmp_path):
    land(events, tmp_path, 0, [event(f"2024-01-0{d} 10:00:00", userId=u) for d in (1, 2, 3) for u in (1, 2)])
    run_incremental(spark, f"{tmp_path}/raw", f"{tmp_path}/days")
    first = day_files(tmp_path)
    assert set(first) == {"day=2024-01-01", "day=2024-01-02", "day=2024-01-03"}
    for number in (1, 2):  # the same day changes twice
        land(events, tmp_path, number, [event("2024-01-02 11:00:00", userId=2 + number), event("2024-01-02 10:00:00")])
        done = run_incremental(spark, f"{tmp_path}/raw", f"{tmp_path}/days")
        assert done == {"new_plays": 2, "touched_days": 1, "recounted_days": 1}
        after = day_files(tmp_path)
        assert {d for d in first if first[d] != after[d]} == {"day=2024-01-02"}
        first = after
    check(spark, tmp_path)


def test_an_earlier_play_corrects_retention_of_the_old_first_day(spark, events, tmp_path):
    land(events, tmp_path, 0, [event("2024-01-05 10:00:00"), event("2024-01-06 10:00:00", userId=2)])
    run_incremental(spark, f"{tmp_path}/raw", f"{tmp_path}/days")
    land(events, tmp_path, 1, [event("2024-01-02 10:00:00"), event("2024-01-09 10:00:00", page="Home")])
    done = run_incremental(spark, f"{tmp_path}/raw", f"{tmp_path}/days")
    assert done == {"new_plays": 1, "touched_days": 1, "recounted_days": 2}
    got = {(str(r.play_date), r.user_type): r.user_count for r in DayStore(spark, f"{tmp_path}/days").retention().collect()}
    assert got == {("2024-01-02", "new"): 1, ("2024-01-05", "returning"): 1, ("2024-01-06", "new"): 1}
    check(spark, tmp_path)


def test_a_survivor_with_another_time_moves_its_user(spark, events, tmp_path):
    same = event("2024-01-05 10:00:00")
    land(events, tmp_path, 0, [{**same, "event_ts": "2024-01-03 10:00:00", "kafka_timestamp": "2024-01-05 10:00:09"}])
    run_incremental(spark, f"{tmp_path}/raw", f"{tmp_path}/days")
    land(events, tmp_path, 1, [{**same, "event_ts": "2024-01-04 10:00:00", "kafka_timestamp": "2024-01-05 10:00:01"}])
    run_incremental(spark, f"{tmp_path}/raw", f"{tmp_path}/days")
    check(spark, tmp_path)
    assert [str(r.first_day) for r in DayStore(spark, f"{tmp_path}/days").first_days().collect()] == ["2024-01-04"]


@pytest.mark.parametrize("lost_at", [1, 4, 6])
def test_a_run_that_is_lost_is_run_again(spark, events, tmp_path, monkeypatch, lost_at):
    drawn = some_events(11, 30)
    land(events, tmp_path, 0, drawn[::2])
    run_incremental(spark, f"{tmp_path}/raw", f"{tmp_path}/days")
    land(events, tmp_path, 1, drawn[1::2])
    done = itertools.count()

    def counting(write):
        def step(*args, **options):
            if next(done) == lost_at:
                raise RuntimeError("lost")
            return write(*args, **options)

        return step

    with monkeypatch.context() as patched:
        patched.setattr(DayStore, "swap", counting(DayStore.swap))
        patched.setattr(incremental.versions, "write_version", counting(incremental.versions.write_version))
        with pytest.raises(RuntimeError, match="lost"):
            run_incremental(spark, f"{tmp_path}/raw", f"{tmp_path}/days")
    land(events, tmp_path, 2, [event("2024-01-01 00:00:01", userId=u) for u in range(1, 9)])
    run_incremental(spark, f"{tmp_path}/raw", f"{tmp_path}/days")
    check(spark, tmp_path)


def test_several_streams_and_rows_outside_of_them(spark, events, tmp_path):
    land(events, tmp_path, 4, [event("2024-01-01 10:00:00")])
    run_incremental(spark, f"{tmp_path}/raw", f"{tmp_path}/days")
    files.write_parquet(events(event("2024-01-02 10:00:00", userId=2)), f"{tmp_path}/raw/run=b/batch_id=0")
    land(events, tmp_path, 5, [event("2024-01-03 10:00:00", userId=3)])
    assert run_incremental(spark, f"{tmp_path}/raw", f"{tmp_path}/days")["new_plays"] == 2
    check(spark, tmp_path)


def test_survivors_are_moved_and_sorted_once(spark, events, tmp_path):
    """No wide sort of whole scan splits before the shuffle, and files by day need no shuffle of their own."""
    files.write_parquet(events(*some_events(3)), f"{tmp_path}/raw")
    raw = files.read_events(spark, f"{tmp_path}/raw")
    found = plan(daily.survivors(daily.with_day(raw), raw)).split("Exchange rangepartitioning")
    assert len(found) == 2 and "Exchange" not in found[0]
    assert "Aggregate" in found[0] and "Aggregate" not in found[1]
    assert found[0].count("Sort [") == 1 and "Sort [" not in found[1]


def test_days_are_swapped_by_moving_their_files(spark, events, tmp_path):
    def stage(name, *plays):
        held = daily.with_day(events(*plays))
        held.coalesce(1).write.partitionBy("day").parquet(f"{tmp_path}/{name}")
        return {path.name for path in Path(f"{tmp_path}/{name}").rglob("*.parquet")}

    old = stage("store", event("2024-01-01 10:00:00"), event("2024-01-02 10:00:00"), event(None))
    new = stage("staged", event("2024-01-02 11:00:00"), event(None), event("2024-01-03 10:00:00"))
    versions.replace_folders(spark, f"{tmp_path}/staged", f"{tmp_path}/store")
    kept = {path.parent.name: path.name for path in Path(f"{tmp_path}/store").rglob("*.parquet")}
    assert len(kept) == 4 and kept["day=2024-01-01"] in old
    assert {name for day, name in kept.items() if day != "day=2024-01-01"} == new
    assert not list(Path(f"{tmp_path}/staged").rglob("*.parquet"))


def test_a_swap_that_is_lost_half_way_loses_no_row(spark, events, tmp_path, monkeypatch):
    land(events, tmp_path, 0, [event(f"2024-01-0{d} 10:00:00", userId=d) for d in (1, 2, 3)])
    run_incremental(spark, f"{tmp_path}/raw", f"{tmp_path}/days")
    land(events, tmp_path, 1, [event(f"2024-01-0{d} 11:00:00", userId=d) for d in (1, 2, 3)])
    moved = itertools.count()
    move = versions.move

    def lost(*args):
        if next(moved) == 1:
            raise RuntimeError("lost")
        move(*args)

    with monkeypatch.context() as patched:
        patched.setattr(versions, "move", lost)
        with pytest.raises(RuntimeError, match="lost"):
            run_incremental(spark, f"{tmp_path}/raw", f"{tmp_path}/days")
    assert DayStore(spark, f"{tmp_path}/days").clean().count() >= 3
    run_incremental(spark, f"{tmp_path}/raw", f"{tmp_path}/days")
    check(spark, tmp_path)
