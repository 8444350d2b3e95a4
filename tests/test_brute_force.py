"""Views, features and merges against plain Python on random events full of nulls and ties."""

import random
from collections import defaultdict
from datetime import datetime, timedelta, timezone
from decimal import ROUND_HALF_UP, Decimal

import pytest

from playlake.operators import clean, features, merge, views
from playlake.schema import EVENT_DDL, EVENT_COLUMNS
from tests.conftest import rows

START = datetime(2024, 1, 30, 22, 0, tzinfo=timezone.utc)


def random_events(seed: int, n: int = 400) -> list[dict]:
    """A third of the rows share one user, a third one song; keys may be null."""
    rng = random.Random(seed)

    def maybe(value):
        return None if rng.random() < 0.1 else value

    out = []
    for _ in range(n):
        at = START + timedelta(seconds=rng.randrange(0, 6 * 86400, 997))
        user = maybe(1 if rng.random() < 0.33 else rng.randrange(2, 12))
        out.append(
            dict.fromkeys(EVENT_COLUMNS)
            | {
                "artist": maybe(f"a{rng.randrange(3)}"),
                "song": maybe("hit" if rng.random() < 0.33 else f"s{rng.randrange(6)}"),
                "duration": maybe(rng.randrange(0, 4000) / 8),
                "ts": int(at.timestamp() * 1000),
                "userId": user,
                "sessionId": maybe(rng.randrange(4)),
                "page": rng.choice(["NextSong"] * 4 + ["Home", None]),
                "level": maybe(rng.choice(["free", "paid"])),
                "location": maybe(rng.choice(["A, X", "B, Y", "C,X", "Z"])),
                "event_ts": maybe(at),
                "kafka_timestamp": START + timedelta(seconds=rng.randrange(1000)),
                "ingestion_time": at + timedelta(seconds=rng.randrange(7200)),
                "itemInSession": rng.randrange(1000),
            }
        )
    return out


def half_up(value, places=1):
    if value is None:
        return None
    step = Decimal(1).scaleb(-places)
    return float(Decimal(repr(round(value, 9))).quantize(step, ROUND_HALF_UP))


def mean(values, places=1):
    held = [v for v in values if v is not None]
    return half_up(sum(held) / len(held), places) if held else None


def distinct(values):
    return len({v for v in values if v is not None})


def grouped(data, *keys):
    groups = defaultdict(list)
    for row in data:
        groups[tuple(row[k] for k in keys)].append(row)
    return groups


def col(group, name):
    return [row[name] for row in group]


def naive(moment):
    return moment.astimezone(timezone.utc).replace(tzinfo=None)


def in_order(items):
    return sorted(items, key=repr)


@pytest.fixture(scope="module", params=[1, 2])
def case(request, spark):
    raw = random_events(request.param)
    frame = spark.createDataFrame([tuple(r[c] for c in EVENT_COLUMNS) for r in raw], EVENT_DDL)
    return raw, frame.repartition(5).cache()


@pytest.fixture(scope="module")
def cleaned(case):
    """Clean rows by brute force, and Spark's."""
    raw, frame = case
    kept = {}
    for row in raw:
        if row["page"] == "NextSong":
            key = (row["userId"], row["sessionId"], row["ts"])
            order = [row["kafka_timestamp"], row["ingestion_time"]] + [
                (row[c] is not None, row[c] if row[c] is not None else 0)
                for c in EVENT_COLUMNS
                if c not in ("userId", "sessionId", "ts", "kafka_timestamp", "ingestion_time")
            ]
            if key not in kept or order < kept[key][0]:
                kept[key] = (order, row)
    rows_kept = []
    for _, row in kept.values():
        filled = row["event_ts"] or datetime.fromtimestamp(row["ts"] / 1000, timezone.utc)
        rows_kept.append(row | {"event_ts": naive(filled)})
    return rows_kept, clean.clean_events(frame).cache()


def test_clean(case, cleaned):
    data, frame = cleaned
    want = [(r["userId"], r["sessionId"], r["ts"], r["itemInSession"], r["event_ts"]) for r in data]
    assert rows(frame, "userId", "sessionId", "ts", "itemInSession", "event_ts") == in_order(want)
    assert rows(clean.clean_counts(case[1])) == [(len(case[0]), len(data), len(case[0]) - len(data))]


def test_overview(cleaned):
    data, frame = cleaned
    timed = [d for d in col(data, "duration") if d is not None]
    want = (
        len(data), distinct(col(data, "userId")), distinct(col(data, "artist")),
        distinct(col(data, "song")), distinct(col(data, "sessionId")),
        mean(timed), half_up(min(timed)), half_up(max(timed)),
    )
    assert rows(views.overview(frame)) == [want]


def test_songs_and_artists(cleaned):
    data, frame = cleaned
    songs = [
        (*k, len(g), distinct(col(g, "userId")), mean(col(g, "duration")))
        for k, g in grouped(data, "song", "artist").items()
    ]
    artists = [
        (*k, len(g), distinct(col(g, "userId")), distinct(col(g, "song")))
        for k, g in grouped(data, "artist").items()
    ]
    for facts in (frame, views.listener_tracks(frame)):
        assert rows(views.top_songs(facts)) == in_order(songs)
        assert rows(views.top_artists(facts)) == in_order(artists)


def test_levels(cleaned):
    data, frame = cleaned
    pairs = len({(r["userId"], r["level"]) for r in data})
    want = [
        (
            *k, len(g), distinct(col(g, "userId")), mean(col(g, "duration")),
            half_up(sum(d for d in col(g, "duration") if d is not None) / 3600, 2),
            half_up(distinct(col(g, "userId")) / pairs * 100),
        )
        for k, g in grouped(data, "level").items()
    ]
    assert rows(views.level_ratio(frame)) == in_order(want)


def test_sessions(cleaned):
    data, frame = cleaned
    want = []
    for k, g in grouped(data, "userId", "sessionId").items():
        timed = [d for d in col(g, "duration") if d is not None]
        first, last = min(col(g, "event_ts")), max(col(g, "event_ts"))
        want.append(
            (
                *k, len(g), half_up(sum(timed) / 60) if timed else None, first, last,
                half_up((last - first) // timedelta(seconds=1) / 60),
            )
        )
    assert rows(views.session_stats(frame)) == in_order(want)


def test_days_and_hours(cleaned):
    data, frame = cleaned
    known = [r | {"day": r["event_ts"].date()} for r in data if r["userId"] is not None]
    first = {k[0]: min(col(g, "day")) for k, g in grouped(known, "userId").items()}
    typed = [r | {"kind": "new" if r["day"] == first[r["userId"]] else "returning"} for r in known]
    retention = [(*k, distinct(col(g, "userId")), len(g)) for k, g in grouped(typed, "day", "kind").items()]
    hourly = [r | {"hour": r["event_ts"].replace(minute=0, second=0, microsecond=0)} for r in data]
    active = [(*k, distinct(col(g, "userId")), len(g)) for k, g in grouped(hourly, "hour").items()]
    for facts in (frame, views.listener_hours(frame)):
        assert rows(views.retention(facts)) == in_order(retention)
        assert rows(views.active_users_ts(facts)) == in_order(active)


def test_user_features(cleaned):
    data, frame = cleaned
    want = []
    for k, g in grouped(data, "userId").items():
        last = max(g, key=lambda r: (r["event_ts"], r["level"] is not None, r["level"] or ""))
        want.append(
            (
                *k, len(g), distinct(col(g, "artist")), distinct(col(g, "song")),
                distinct(col(g, "sessionId")), mean(col(g, "duration")),
                len({r["event_ts"].date() for r in g}), last["level"],
            )
        )
    assert rows(features.user_features(frame)) == in_order(want)
    tables = views.listener_tracks(frame), views.listener_hours(frame), views.session_stats(frame)
    assert rows(features.user_features_of_tables(*tables)) == in_order(want)


def test_time_labels(cleaned):
    data, frame = cleaned
    first, last = min(col(data, "event_ts")), max(col(data, "event_ts"))
    cutoff = first + (last - first) * 0.8
    early = {r["userId"] for r in data if r["event_ts"] <= cutoff} - {None}
    late = {r["userId"] for r in data if r["event_ts"] > cutoff}
    assert rows(features.churn_labels_time(frame)) == in_order([(u, int(u not in late)) for u in early])
    assert rows(features.churned_users(frame).dropna()) == in_order([(u,) for u in early - late])


def test_merge(cleaned):
    data, frame = cleaned
    middle = int((START + timedelta(days=3)).timestamp() * 1000)
    old, new = frame.filter(frame.ts < middle), frame.filter(frame.ts >= middle)
    batch = grouped([r for r in data if r["ts"] < middle], "artist")
    speed = grouped([r for r in data if r["ts"] >= middle], "artist")
    want = []
    for key in set(batch) | set(speed):
        b, s = batch.get(key, []), speed.get(key, [])
        whole = (
            *key, len(b), distinct(col(b, "userId")), distinct(col(b, "song")) if b else None,
            len(s), distinct(col(s, "userId")), len(b) + len(s),
        )
        if key != (None,):
            want.append(whole)
            continue
        if b:  # null keys stay apart
            want.append((*whole[:4], 0, 0, len(b)))
        if s:
            want.append((None, 0, 0, None, *whole[4:6], len(s)))
    got = merge.merged_top_artists(views.top_artists(old), merge.speed_top_artists(new))
    assert rows(got) == in_order(want)
