"""Bucketed tables join without a shuffle; quantile sketches merge with little error."""

import uuid

import pytest
from pyspark.sql import functions as F

from checks import queries
from checks.queries import batch, order_clean, order_habits, speed
from playlake.operators import features, merge, views
from playlake.sources.catalog import Catalog
from tests.conftest import SMALL, plan, rows


@pytest.fixture(scope="module")
def db(spark, tmp_path_factory):
    name = f"buckets_{uuid.uuid4().hex[:8]}"
    yield Catalog(spark, name, str(tmp_path_factory.mktemp("db")))
    spark.sql(f"DROP DATABASE {name} CASCADE")


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_habits_store_only_the_columns_they_read(spark, monkeypatch):
    monkeypatch.setattr(queries, "_tables", {})
    want = sorted(order_habits(spark, SMALL).collect())
    stored = {name: path for (_, _, name), path in queries._tables.items()}
    assert set(stored) == {"order_listens", "order_churn_features"}
    listens = spark.read.parquet(stored["order_listens"])
    assert listens.columns == ["userId", "sessionId", "event_ts", "artist", "song", "duration", "level"]
    assert sorted(features.churn_features(order_clean(spark, SMALL)).collect()) == want


def below_join(text: str) -> str:
    """The plan from its first sort-merge join on, without subqueries."""
    main = text.split("Subquery")[0] if "SortMergeJoin" in text.split("Subquery")[0] else text
    return main[main.index("SortMergeJoin") :]


def test_features_join_labels_without_a_shuffle(spark, db, no_broadcast):
    habits, events = order_habits(spark, SMALL), order_clean(spark, SMALL)
    labels = features.churn_labels_time(events)
    parts = [
        db.store_bucketed("habits", habits, "userId", buckets=8),
        db.store_bucketed("labels", labels, "userId", buckets=8),
    ]
    joined = parts[0].join(parts[1], "userId")
    text = plan(joined)
    assert "SortMergeJoin" in text and "Exchange" not in text
    dataset = features.churn_dataset(*parts)
    executed = [line for line in plan(dataset).splitlines() if "Subquery" not in line]
    first = next(n for n, line in enumerate(executed) if "SortMergeJoin" in line)
    inner = "\n".join(executed[first:])
    assert "Exchange hashpartitioning(userId" not in inner
    assert rows(dataset) == rows(features.churn_dataset(habits, labels))


def test_songs_merge_without_a_shuffle(spark, db, no_broadcast):
    old, new = views.top_songs(batch(spark, SMALL)), merge.speed_top_songs(speed(spark, SMALL))
    parts = [
        db.store_bucketed("songs", old, "song", "artist", buckets=8),
        db.store_bucketed("fresh", new, "song", "artist", buckets=8),
    ]
    merged = merge.merged_top_songs(*parts)
    assert "SortMergeJoin" in plan(merged) and "Exchange" not in plan(merged)
    assert rows(merged) == rows(merge.merged_top_songs(old, new))


def test_null_keys_and_empty_tables_in_buckets(spark, db):
    odd = spark.createDataFrame([(None, 1), (2, 2), (2, 3)], "userId int, v int")
    assert rows(db.store_bucketed("odd", odd, "userId", buckets=4)) == rows(odd)
    assert db.store_bucketed("odd", odd.limit(0), "userId", buckets=4).count() == 0


def test_merged_sketches_have_little_error(spark):
    users = spark.range(200_000).select(
        (F.pmod(F.xxhash64("id"), F.lit(1_000_003)) / 1000).alias("plays_per_day"),
        F.pmod(F.xxhash64("id", F.lit(5)), F.lit(90)).alias("active_days"),
        (F.col("id") % 11).alias("cohort"),
    )
    sketches = features.engagement_sketches(users, "cohort")
    assert sketches.count() == 11
    assert sketches.agg(F.max(F.octet_length("plays_per_day"))).first()[0] < 200_000
    bars = features.sketched_quartiles(sketches).first()
    below = users.filter(F.col("plays_per_day") <= bars["plays_per_day_q25"]).count() / 200_000
    assert abs(below - 0.25) < 0.01
    low, high = (users.filter(c).count() / 200_000 for c in (F.col("active_days") < bars["active_days_q25"], F.col("active_days") <= bars["active_days_q25"]))
    assert low - 0.01 < 0.25 < high + 0.01


def test_sketched_bars_label_the_same_users(spark):
    habits = order_habits(spark, SMALL)
    sketches = features.engagement_sketches(habits.withColumn("part", F.col("userId") % 5), "part")
    bars = features.sketched_quartiles(sketches)
    assert rows(bars) == rows(features.engagement_quartiles(habits))
    assert rows(features.churn_labels_engagement(habits, bars)) == rows(features.churn_labels_engagement(habits))


def test_sketches_of_no_users(spark):
    none = spark.createDataFrame([], "plays_per_day double, active_days long")
    assert rows(features.sketched_quartiles(features.engagement_sketches(none))) == [(None, None)]
    gaps = spark.createDataFrame([(None, 3), (1.0, None)], "plays_per_day double, active_days long")
    assert rows(features.sketched_quartiles(features.engagement_sketches(gaps))) == [(1.0, 3)]
