import pytest
from pyspark.sql import functions as F

from checks.queries import cleaned, order_clean
from playlake.operators import churn, clean, features, questions, segments
from playlake.plans.models import run_churn, run_segments
from playlake.sources.files import read_view
from tests.conftest import SMALL, event, plan, rows


@pytest.fixture(scope="module")
def orders_churn(spark, tmp_path_factory):
    store = str(tmp_path_factory.mktemp("orders_churn"))
    predictions, summary = run_churn(spark, order_clean(spark, SMALL), store)
    return store, predictions, summary


@pytest.fixture(scope="module")
def listener_segments(spark, tmp_path_factory):
    store = str(tmp_path_factory.mktemp("segments"))
    return run_segments(spark, features.user_features(cleaned(spark, SMALL)), store)


def set_form_labels(df):
    """Churned and retained users through two distincts, an anti and a semi join."""
    gone = features.churned_users(df).withColumn("label", F.lit(1))
    stayed = features.retained_users(df).withColumn("label", F.lit(0))
    return gone.unionByName(stayed)


def test_features_of_one_user(plays):
    df = plays(
        event("2024-01-01 23:59:00", level="free"),
        event("2024-01-02 00:01:00", level="paid", song="t", sessionId=2, duration=201.0),
    )
    row = features.user_features(df).first().asDict()
    assert row == {
        "userId": 1, "total_plays": 2, "unique_artists": 1, "unique_songs": 2, "total_sessions": 2,
        "avg_duration": 150.5, "active_days": 2, "level": "paid",
    }


def test_null_user_and_null_level_are_kept(plays):
    df = plays(event(userId=None, level=None), event(userId=None, level=None), event())
    got = rows(features.user_features(df), "userId", "total_plays", "level")
    assert got == [(1, 1, "free"), (None, 2, None)]


def test_days_span_counts_date_boundaries(plays):
    late = [event(f"2024-03-{d:02d} 00:00:00", userId=9) for d in (1, 2)]
    df = plays(event("2024-01-01 23:59:00"), event("2024-01-02 00:01:00"), *late)
    row = features.churn_features(df).filter("userId = 1").first()
    assert (row["days_span"], row["plays_per_day"]) == (1, 1.0)


@pytest.mark.parametrize("source", [cleaned, order_clean])
def test_time_labels_equal_their_set_form(spark, source):
    df = source(spark, SMALL)
    assert rows(features.churn_labels_time(df)) == rows(set_form_labels(df), "userId", "label")


def test_quartiles_equal_the_quantile_of_spark(spark):
    df = features.churn_features(cleaned(spark, SMALL)).cache()
    low = df.approxQuantile(["plays_per_day", "active_days"], [0.25], 0.0)
    row = features.engagement_quartiles(df).first()
    assert [row[0], row[1]] == [low[0][0], low[1][0]]


def test_both_label_kinds_are_reached(spark):
    for source, kind in ((cleaned, "engagement"), (order_clean, "time")):
        df = source(spark, SMALL)
        data = features.churn_dataset(features.churn_features(df), features.churn_labels_time(df))
        assert rows(data.select("label_kind").distinct()) == [(kind,)]
        assert data.filter("label not in (0, 1)").count() == 0
        assert data.count() == features.churn_labels_time(df).count()


def test_split_is_stable_and_about_80_percent(spark):
    df = spark.range(10000).withColumnRenamed("id", "userId")
    train, holdout = churn.holdout_split(df)
    assert rows(train) == rows(churn.holdout_split(df.repartition(13))[0])
    assert 7700 < train.count() < 8300
    assert train.count() + holdout.count() == 10000


def test_segments_cover_every_user_once(spark, listener_segments):
    named, profiles = listener_segments
    users = features.user_features(cleaned(spark, SMALL)).count()
    assert named.count() == named.select("userId").distinct().count() == users
    assert named.select("segment").distinct().count() <= 4
    means = {r["segment_label"]: r["avg_plays"] for r in profiles.collect()}
    order = [means[n] for n in ("Power Users", "Regular Listeners", "Casual Listeners", "At-Risk Users")]
    assert order == sorted(order, reverse=True)
    assert profiles.agg(F.sum("user_count")).first()[0] == users
    assert questions.users_per_segment(profiles).columns == ["segment_label", "user_count"]


def test_more_segments_than_names(spark):
    df = spark.createDataFrame([(i, 10.0 * i) for i in range(6)], "segment int, total_plays double")
    names = [r["segment_label"] for r in segments.segment_ranks(df).orderBy("segment").collect()]
    assert names == [
        "Segment 5", "Segment 4", "At-Risk Users", "Casual Listeners", "Regular Listeners", "Power Users",
    ]


def test_segments_survive_missing_levels_and_durations(spark, plays, tmp_path):
    users = [event(userId=n, song=f"s{n % 7}") for n in range(1, 40) for _ in range(n % 5 + 1)]
    odd = [event(userId=90, level=None), event(userId=91, duration=None), event(userId=None)]
    named, _ = run_segments(spark, features.user_features(plays(*users, *odd)), str(tmp_path))
    assert named.count() == 42


def test_churn_probabilities(spark, orders_churn):
    store, predictions, summary = orders_churn
    assert dict(predictions.dtypes)["churn_probability"] == "double"
    assert predictions.filter("churn_probability not between 0 and 1").count() == 0
    assert predictions.count() == predictions.select("userId").distinct().count()
    row = summary.first()
    assert row["total_users"] == row["high_risk"] + row["medium_risk"] + row["low_risk"]
    assert row["total_users"] == read_view(spark, f"{store}/churn_dataset").count()
    assert 0.0 <= row["auc_roc"] <= 1.0
    counts = dict(rows(churn.churn_risk_counts(predictions)))
    assert sum(counts.values()) == row["total_users"]


def test_scoring_stays_in_the_jvm(spark, orders_churn):
    assert "Python" not in plan(orders_churn[1])


def test_at_risk_users_are_paying_and_named(spark, orders_churn):
    _, predictions, _ = orders_churn
    events = order_clean(spark, SMALL)
    lowered = predictions.withColumn("risk_level", F.lit("High"))
    got = questions.at_risk_users(lowered, events).collect()
    assert len(got) == 4 and all(r["firstName"].startswith("Customer#") for r in got)
    best = lowered.filter("level = 'paid'").agg(F.max("churn_probability")).first()[0]
    assert max(r["churn_probability"] for r in got) == best
    assert got and questions.at_risk_users(predictions.limit(0), events).count() == 0


def test_one_class_does_not_break_churn(spark, plays, tmp_path):
    # Everyone is active to the end with the same habits: no time churn, and
    # every user is at the quartile, so engagement labels are all 1.
    days = ["2024-01-01 00:00:00", "2024-01-05 00:00:00", "2024-01-11 00:00:00"]
    df = plays(*[event(d, userId=n) for d in days for n in range(30)])
    predictions, summary = run_churn(spark, df, str(tmp_path))
    assert predictions.select("label").distinct().count() == 1
    assert summary.first()["auc_roc"] is None


def test_all_retained_gives_probability_zero(spark, tmp_path):
    rows_in = [(n, n % 3, 1, 1, 1, 100.0, 1, 1, 1.0, "free", 0) for n in range(40)]
    data = spark.createDataFrame(
        rows_in,
        "userId int, total_plays long, unique_artists long, unique_songs long, total_sessions long, "
        "avg_duration double, active_days long, days_span int, plays_per_day double, level string, label int",
    )
    model = churn.fit_churn(data, str(tmp_path / "model"))
    scored = churn.score(model, data)
    assert rows(scored.select("churn_probability", "risk_level").distinct()) == [(0.0, "Low")]


def test_no_events_give_empty_results(spark, plays, tmp_path):
    predictions, summary = run_churn(spark, plays(), str(tmp_path))
    assert predictions.count() == 0
    assert summary.first()["total_users"] == 0


def test_cutoff_is_computed_once_per_plan(spark):
    df = cleaned(spark, SMALL)
    text = plan(clean.time_split(df)[0])
    assert "Subquery" in text and "Join" not in text


def test_models_do_not_depend_on_the_layout(spark, tmp_path):
    held = order_clean(spark, SMALL)
    results = []
    for parts, adaptive in ((2, "true"), (16, "false")):
        spark.conf.set("spark.sql.shuffle.partitions", str(parts))
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
        try:
            store = f"{tmp_path}/{parts}"
            named, _ = run_segments(spark, features.user_features(held), store)
            scored, summary = run_churn(spark, held, store)
            results.append((rows(named, "userId", "segment"), rows(scored, "userId", "churn_probability"), rows(summary)))
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "4")
            spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert results[0] == results[1]
