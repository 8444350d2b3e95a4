"""Every operator as a query (spark, sf_dir) -> DataFrame over the given tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from playlake import fixed
from playlake.functions.labels import risk_band
from playlake.functions.numbers import half_up
from playlake.operators import audience, churn, clean, counts, features, merge, model_tables, questions, segments, views
from playlake.plans import models
from playlake.plans.batch import run_batch
from playlake.plans.incremental import DayStore, run_incremental
from playlake.plans.serving import load_catalog, run_serving
from playlake.schema import PAYLOAD_COLUMNS
from playlake.session import fresh_dir, prepare, shuffles_for
from playlake.sources import catalog, files, messages, testdata, versions
from playlake.streaming import plays as stream

Query = Callable[[SparkSession, str], DataFrame]

_tables: dict[tuple[str, str, str], str] = {}
_catalogs: dict[tuple[str, str], catalog.Catalog] = {}
_sizes: dict[tuple[str, str], int] = {}


def _stored(spark: SparkSession, sf_dir: str, name: str, build: Callable[[], DataFrame]) -> str:
    """Path of a table written once per session, as the batch layer does."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _tables:
        path = fresh_dir(spark, name)
        files.write_parquet(build(), path)
        _tables[key] = path
    return _tables[key]


def sized(spark: SparkSession, sf_dir: str) -> SparkSession:
    """The session with pinned settings, and shuffles cut for the tables that play events come from."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _sizes:
        _sizes[key] = files.stored_bytes(spark, f"{sf_dir}/{{customer,part,orders,lineitem,events}}.parquet")
    prepare(spark)
    shuffles_for(spark, _sizes[key])
    return spark


def raw_path(spark: SparkSession, sf_dir: str) -> str:
    return _stored(spark, sf_dir, "raw", lambda: testdata.raw_events(spark, sf_dir))


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw events of fixture A, replays included, as the stream left them."""
    return files.read_events(spark, raw_path(spark, sf_dir))


def plain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw events of fixture A without replays."""
    path = _stored(spark, sf_dir, "plain", lambda: testdata.event_plays(spark, sf_dir))
    return files.read_events(spark, path)


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw events of fixture B."""
    path = _stored(spark, sf_dir, "orders", lambda: testdata.order_plays(spark, sf_dir))
    return files.read_events(spark, path)


def clean_path(spark: SparkSession, sf_dir: str) -> str:
    """Clean events of fixture A, in one plan with their mapping, as for fixture B."""
    return _stored(spark, sf_dir, "clean", lambda: clean.clean_events(testdata.raw_events(spark, sf_dir)))


def cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean events of fixture A, the input of the batch views."""
    return files.read_events(spark, clean_path(spark, sf_dir))


def order_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean events of fixture B, in one plan with their mapping: the raw table is not stored in between."""
    path = _stored(
        spark, sf_dir, "order_clean", lambda: clean.clean_events(testdata.order_plays(spark, sf_dir))
    )
    return files.read_events(spark, path)


def order_listens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What user features and churn read of the clean events of fixture B: 7 columns of 20.

    Unless the whole clean table is there already, these are cleaned and stored by themselves.
    """
    if (spark.sparkContext.applicationId, sf_dir, "order_clean") in _tables:
        return order_clean(spark, sf_dir)
    path = _stored(
        spark,
        sf_dir,
        "order_listens",
        lambda: clean.clean_columns(testdata.order_plays(spark, sf_dir), "artist", "song", "duration", "level"),
    )
    return files.read_view(spark, path)


def batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaned(spark, sf_dir).filter(testdata.speed_start(batch=True))


def speed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaned(spark, sf_dir).filter(testdata.speed_start(batch=False))


def habits(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _stored(
        spark, sf_dir, "churn_features", lambda: features.churn_features(cleaned(spark, sf_dir))
    )
    return files.read_view(spark, path)


def order_habits(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _stored(
        spark,
        sf_dir,
        "order_churn_features",
        lambda: features.churn_features(order_listens(spark, sf_dir)),
    )
    return files.read_view(spark, path)


def database(spark: SparkSession, sf_dir: str) -> catalog.Catalog:
    """A database over stored batch and speed events, declared once per session."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _catalogs:
        batch_path = _stored(spark, sf_dir, "batch", lambda: batch(spark, sf_dir))
        speed_path = _stored(spark, sf_dir, "speed", lambda: speed(spark, sf_dir))
        location = fresh_dir(spark, "database")
        name = "playlake_" + location.rsplit("-", 1)[1][:12]
        _catalogs[key] = load_catalog(spark, name, batch_path, speed_path, location, None)
    return _catalogs[key]


def whole_database(spark: SparkSession, sf_dir: str) -> catalog.Catalog:
    """A database over all clean events, declared once per session."""
    key = (spark.sparkContext.applicationId, f"{sf_dir} whole")
    if key not in _catalogs:
        location = fresh_dir(spark, "whole-database")
        name = "playlake_all_" + location.rsplit("-", 1)[1][:12]
        _catalogs[key] = catalog.Catalog(spark, name, location)
        _catalogs[key].play_events(clean_path(spark, sf_dir))
    return _catalogs[key]


def _sql_text(name: str) -> Query:
    return lambda spark, sf_dir: whole_database(spark, sf_dir).sql_text(name)


def _on(source: Query, view: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: view(source(spark, sf_dir))


def _sql(build: Callable[[catalog.Catalog], DataFrame]) -> Query:
    return lambda spark, sf_dir: build(database(spark, sf_dir))


def _json_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_dir(spark, "json")
    files.write_json(cleaned(spark, sf_dir), path)
    return files.read_json_events(spark, path)


def _parse_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return messages.parse_messages(messages.to_messages(plain(spark, sf_dir)))


def _time_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    early, late = clean.time_split(cleaned(spark, sf_dir))
    parts = early.withColumn("period", F.lit("early")).unionByName(
        late.withColumn("period", F.lit("late"))
    )
    return parts.groupBy("period").agg(
        F.count(F.lit(1)).alias("events"),
        F.min("event_ts").alias("first_event"),
        F.max("event_ts").alias("last_event"),
    )


def _risk_band(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bands over each listener's share of time in the longest possible plays."""
    share = half_up(F.avg("duration") / 100, 2)
    per_user = cleaned(spark, sf_dir).groupBy("userId").agg(share.alias("probability"))
    return per_user.withColumn("risk_level", risk_band(F.col("probability")))


def _churn_dataset(habits_of: Query, events_of: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        labels = features.churn_labels_time(events_of(spark, sf_dir))
        return features.churn_dataset(habits_of(spark, sf_dir), labels)

    return run


def _stored_run(name: str, run: Callable[..., object], events_of: Query) -> Callable[[str], Query]:
    """Queries on the tables of a run that is done once per session."""

    def table(output: str) -> Query:
        def read(spark: SparkSession, sf_dir: str) -> DataFrame:
            key = (spark.sparkContext.applicationId, sf_dir, name)
            if key not in _tables:
                store = fresh_dir(spark, name)
                run(spark, events_of(spark, sf_dir), store)
                _tables[key] = store
            return files.read_view(spark, f"{_tables[key]}/{output}")

        return read

    return table


def _user_features_of_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = cleaned(spark, sf_dir)
    return features.user_features_of_tables(
        views.listener_tracks(held), views.listener_hours(held), views.session_stats(held)
    )


_segments = _stored_run(
    "segment_run", models.run_segments, _on(cleaned, features.user_features)
)
_churn = _stored_run("churn_run", models.run_churn, cleaned)
_order_churn = _stored_run("order_churn_run", models.run_churn, order_listens)


def _of_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every user's probability from the stored rows of the forest."""
    parts = [_order_churn(name)(spark, sf_dir) for name in ("churn_dataset", "churn_inputs", "churn_levels", "churn_nodes")]
    return model_tables.banded(model_tables.forest_scores(*parts))


def _importances(spark: SparkSession, sf_dir: str) -> DataFrame:
    return model_tables.importances(*(_order_churn(name)(spark, sf_dir) for name in ("churn_nodes", "churn_inputs")))


def _of_centres(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every user's segment from the stored rows of the centres."""
    parts = [_segments(name)(spark, sf_dir) for name in ("user_features", "segment_inputs", "segment_levels", "segment_centres")]
    return model_tables.assigned(*parts).select("userId", "segment", *features.HABIT_COLUMNS, "level")


#: A forest of two small trees, as an analyst may write one: (tree, node, feature, threshold, low, high, share).
RULES = [
    (0, 0, 0, 0.03, 1, 2, None), (0, 1, None, None, None, None, 0.75), (0, 2, 1, 8.0, 3, 4, None),
    (0, 3, None, None, None, None, 0.4), (0, 4, None, None, None, None, 0.125),
    (1, 0, 2, 0.5, 1, 2, None), (1, 1, 1, 5.0, 3, 4, None), (1, 2, None, None, None, None, 0.2),
    (1, 3, None, None, None, None, 0.9), (1, 4, None, None, None, None, 0.35),
]


def _rule_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Churn features of the orders scored by RULES, through the tables of any forest."""
    names = ["plays_per_day", "active_days", model_tables.LEVEL_INPUT]
    inputs = spark.createDataFrame([(n, name, 0.0, 1.0) for n, name in enumerate(names)], model_tables.INPUTS_DDL)
    levels = spark.createDataFrame([("free", 0), ("paid", 1)], model_tables.LEVELS_DDL)
    nodes = spark.createDataFrame([(*rule, 1.0, None) for rule in RULES], model_tables.NODES_DDL)
    users = order_habits(spark, sf_dir).filter("userId is not null").na.fill(0)
    return model_tables.banded(model_tables.forest_scores(users, inputs, levels, nodes, depth=2))


def _nearest_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users by the plan whose mean listener they are nearest to."""
    users = features.user_features(order_listens(spark, sf_dir)).filter("userId is not null").na.fill(0)
    users = files.read_view(spark, _stored(spark, sf_dir, "plan_users", lambda: users))
    names = ["total_plays", "active_days", "avg_duration"]
    inputs, centres = model_tables.group_centres(users, names, "level")
    levels = spark.createDataFrame([], model_tables.LEVELS_DDL)
    return model_tables.assigned(users, inputs, levels, centres).select("userId", *names, "level", "segment")


def _feature_auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    dataset = _churn_dataset(order_habits, order_listens)(spark, sf_dir)
    found = churn.feature_auc(dataset, lambda df: files.read_view(spark, _stored(spark, sf_dir, "feature_ranks", lambda: df)))
    return found.withColumn("auc", half_up(F.col("auc"), 9))


def _run_layers(spark: SparkSession, raw_events: DataFrame, base: str) -> None:
    """A whole batch run over the older raw events, then a serving run with the newer plays.

    Both layers are written in one go, each as a micro-batch of its own, and moved to their places.
    """
    older = testdata.speed_start(batch=True)
    landed = raw_events.withColumn("batch_id", F.when(older, 0).otherwise(1)).filter(older | (~older & complete_play()))
    landed.write.partitionBy("batch_id").parquet(f"{base}/sent")
    for number, layer in enumerate(("raw", "speed")):
        if versions.exists(spark, f"{base}/sent/batch_id={number}"):
            versions.move(spark, f"{base}/sent/batch_id={number}", f"{base}/{layer}/run=a/batch_id={number}")
    run_batch(spark, f"{base}/raw", f"{base}/store", models=False)
    names = [name for name in fixed.PUBLISHED_VIEWS if name not in fixed.MODEL_VIEWS]
    run_serving(spark, f"{base}/store", f"{base}/speed", f"{base}/export", names=names)


def _run_by_day(spark: SparkSession, raw_events: DataFrame, base: str) -> None:
    """Three landings of the raw events, dealt by hash: late and repeated events in each.

    They are written once, for all landings, and then arrive one after the other.
    """
    number = F.pmod(F.xxhash64(*raw_events.columns), F.lit(3))
    raw_events.withColumn("batch_id", number).write.partitionBy("batch_id").parquet(f"{base}/sent")
    for number in range(3):
        if versions.exists(spark, f"{base}/sent/batch_id={number}"):
            versions.move(spark, f"{base}/sent/batch_id={number}", f"{base}/raw/run=a/batch_id={number}")
        run_incremental(spark, f"{base}/raw", f"{base}/days")


def _by_day(view: Callable[[DayStore], DataFrame]) -> Query:
    """A view of the tables by day after all landings."""

    def read(spark: SparkSession, sf_dir: str) -> DataFrame:
        key = (spark.sparkContext.applicationId, sf_dir, "by_day")
        if key not in _tables:
            base = fresh_dir(spark, "by-day")
            _run_by_day(spark, testdata.raw_events(spark, sf_dir), base)
            _tables[key] = base
        return view(DayStore(spark, f"{_tables[key]}/days"))

    return read


def complete_play() -> Column:
    """Condition of a row of the speed layer: a play with user, artist and song."""
    return reduce(and_, [F.col(c).isNotNull() for c in clean.REQUIRED], F.col("page") == fixed.PLAY_PAGE)


def plain_or_mapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw events of fixture A without replays: the stored table if there is one already, else their mapping."""
    if (spark.sparkContext.applicationId, sf_dir, "plain") in _tables:
        return plain(spark, sf_dir)
    return testdata.event_plays(spark, sf_dir)


_layers = _stored_run("layers", _run_layers, plain_or_mapped)


def _without(source: Query, *columns: str) -> Query:
    return lambda spark, sf_dir: source(spark, sf_dir).drop(*columns)


def _at_risk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return questions.at_risk_users(
        _churn("churn_predictions")(spark, sf_dir), cleaned(spark, sf_dir)
    )


def _merged_songs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.merged_top_songs(
        views.top_songs(batch(spark, sf_dir)), merge.speed_top_songs(speed(spark, sf_dir))
    )


def _merged_artists(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.merged_top_artists(
        views.top_artists(batch(spark, sf_dir)), merge.speed_top_artists(speed(spark, sf_dir))
    )


def _merged_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.merged_active_ts(
        views.active_users_ts(batch(spark, sf_dir)), merge.speed_active_ts(speed(spark, sf_dir))
    )


def _late(yes: bool):
    """A split by arrival: every third event counts as landed after the batch run."""
    return (F.col("ts") % 3 == 0) if yes else (F.col("ts") % 3 != 0)


def _sets(name: str, build: Callable[[DataFrame], DataFrame], late: bool) -> Query:
    """A stored table of user sets of the earlier or the later landed plays."""

    def read(spark: SparkSession, sf_dir: str) -> DataFrame:
        key = f"{name}_{'late' if late else 'early'}"
        path = _stored(spark, sf_dir, key, lambda: build(cleaned(spark, sf_dir).filter(_late(late))))
        return files.read_view(spark, path)

    return read


def _merged_sets(name: str, build: Callable[[DataFrame], DataFrame], view: Callable[..., DataFrame]) -> Query:
    """A view of the stored sets of both layers; events are not read again."""
    early, late = _sets(name, build, late=False), _sets(name, build, late=True)
    return lambda spark, sf_dir: view(early(spark, sf_dir), late(spark, sf_dir))


_hour_sets = ("hour_users", audience.hour_users)


def _song_sketches(facts: DataFrame) -> DataFrame:
    return audience.listener_sketches(facts, "song", "artist")


def _speed_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.speed_summary(batch(spark, sf_dir), speed(spark, sf_dir))


def _cohort_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored sketches of the order users' engagement, one row per span of days."""
    def build() -> DataFrame:
        held = order_habits(spark, sf_dir).withColumn("cohort", F.floor(F.col("days_span") / 30))
        return features.engagement_sketches(held, "cohort")

    return files.read_view(spark, _stored(spark, sf_dir, "engagement_sketches", build))


def _sketched_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    bars = features.sketched_quartiles(_cohort_sketches(spark, sf_dir))
    return features.churn_labels_engagement(order_habits(spark, sf_dir), bars)


def _bucketed(*parts: tuple[str, Query, tuple[str, ...]]) -> Callable[[SparkSession, str], list[DataFrame]]:
    """Stored tables in buckets of their keys, written once per session."""

    def tables(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
        db = database(spark, sf_dir)
        for name, build, keys in parts:
            key = (spark.sparkContext.applicationId, sf_dir, f"bucketed {name}")
            if key not in _tables:
                db.store_bucketed(name, build(spark, sf_dir), *keys, buckets=8)
                _tables[key] = db.name(name)
        return [db.table(name) for name, _, _ in parts]

    return tables


_dataset_tables = _bucketed(
    ("churn_features_by_user", order_habits, ("userId",)),
    ("churn_labels_by_user", _on(order_listens, features.churn_labels_time), ("userId",)),
)
_song_tables = _bucketed(
    ("top_songs_by_key", _on(batch, views.top_songs), ("song", "artist")),
    ("speed_songs_by_key", _on(speed, merge.speed_top_songs), ("song", "artist")),
)


def _kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = batch(spark, sf_dir)
    return questions.kpi_summary(views.overview(held), _speed_summary(spark, sf_dir), held)


def _hourly_by_layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return questions.hourly_by_layer(
        views.active_users_ts(batch(spark, sf_dir)), merge.speed_active_ts(speed(spark, sf_dir))
    )


def _merged_unfiltered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Script form: the batch side is raw, of every page."""
    early = plain(spark, sf_dir).filter(testdata.speed_start(batch=True))
    return merge.merged_events(early, speed(spark, sf_dir), filter_batch=False)


def _event_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events file as a stream of JSON messages."""
    return messages.to_messages(testdata.event_stream(spark, sf_dir))


def _stream_append(layer: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        base = fresh_dir(spark, "ingest")
        events = stream.parsed_events(_event_messages(spark, sf_dir))
        query = stream.start_ingest(
            events, f"{base}/raw", f"{base}/speed", f"{base}/checkpoint", every=None
        )
        query.awaitTermination()
        landed = files.read_events(spark, f"{base}/{layer}")
        return landed.select(*PAYLOAD_COLUMNS, "event_ts", "kafka_timestamp")

    return run


def _stream_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = fresh_dir(spark, "window")
    events = stream.parsed_events(_event_messages(spark, sf_dir))
    stream.start_window(events, f"{base}/out", f"{base}/checkpoint", every=None).awaitTermination()
    return files.read_view(spark, f"{base}/out").drop("active_users")


def _stream_level_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = fresh_dir(spark, "levels")
    events = stream.parsed_events(_event_messages(spark, sf_dir))
    query = stream.start_level_summary(events, f"{base}/checkpoint", f"{base}/out", every=None)
    query.awaitTermination()
    return files.read_view(spark, f"{base}/out")


def _stream_level_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = fresh_dir(spark, "level-sets")
    events = stream.parsed_events(_event_messages(spark, sf_dir))
    stream.start_level_sets(events, f"{base}/sets", f"{base}/checkpoint", every=None).awaitTermination()
    return stream.level_users(spark, f"{base}/sets")


def _tally(roll: Callable[[DataFrame], DataFrame]) -> Query:
    """A stored tally, its sums shown without the last bits of a double."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return roll(cleaned(spark, sf_dir)).withColumn("seconds", half_up(F.col("seconds"), 6))

    return run


def _window_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stream.songs_per_window(cleaned(spark, sf_dir)).drop("active_users")


QUERIES: dict[str, Query] = {
    # scans, sinks
    "scan_events": raw,
    "json_roundtrip": _json_roundtrip,
    "parse_json_events": _parse_json,
    # cleaning
    "filter_page": _on(raw, clean.filter_page),
    "dedup_events": _on(raw, clean.dedup),
    "clean_events": _on(raw, clean.clean_events),
    "clean_counts": _on(raw, clean.clean_counts),
    "drop_incomplete": _on(raw, clean.drop_incomplete),
    "time_bounds": _on(cleaned, clean.time_bounds),
    "time_split": _time_split,
    # batch views
    "overview": _on(cleaned, views.overview),
    "top_songs": _on(cleaned, views.top_songs),
    "top_artists": _on(cleaned, views.top_artists),
    "top_locations": _on(cleaned, views.top_locations),
    "plays_by_hour_users": _on(cleaned, lambda df: views.plays_by_hour(df, with_duration=False)),
    "plays_by_hour": _on(cleaned, views.plays_by_hour),
    "level_stats": _on(cleaned, views.level_stats),
    "page_dist": _on(raw, views.page_dist),
    "gender_stats": _on(cleaned, views.gender_stats),
    "top10_songs": _on(cleaned, views.top10_songs),
    "top10_artists": _on(cleaned, views.top10_artists),
    "level_ratio": _on(cleaned, views.level_ratio),
    "session_stats": _on(cleaned, views.session_stats),
    "session_dist": _on(cleaned, lambda df: views.session_dist(views.session_stats(df))),
    "first_play": _on(cleaned, views.first_play),
    "retention": _on(cleaned, views.retention),
    "active_users_ts": _on(cleaned, views.active_users_ts),
    "distinct_user_levels": _on(cleaned, views.distinct_user_levels),
    "approx_listeners": _on(cleaned, views.approx_listeners),
    "listener_tracks": _tally(views.listener_tracks),
    "listener_hours": _tally(views.listener_hours),
    # the same views at the larger scale of fixture B
    "orders_overview": _on(order_clean, views.overview),
    "orders_top_songs": _on(order_clean, views.top_songs),
    "orders_retention": _on(order_clean, views.retention),
    "orders_session_stats": _on(order_clean, views.session_stats),
    "orders_user_features": _on(order_listens, features.user_features),
    # features and labels
    "user_features": _on(cleaned, features.user_features),
    "user_features_of_tables": _user_features_of_tables,
    "profile_by_level": _on(
        cleaned, lambda df: segments.segment_profiles(features.user_features(df), "level")
    ),
    "churn_features": _on(cleaned, features.churn_features),
    "churned_users": _on(order_listens, features.churned_users),
    "retained_users": _on(order_listens, features.retained_users),
    "churn_labels_time": _on(order_listens, features.churn_labels_time),
    "engagement_quartiles": _on(habits, features.engagement_quartiles),
    "churn_labels_engagement": _on(habits, features.churn_labels_engagement),
    "churn_dataset": _churn_dataset(habits, cleaned),
    "churn_dataset_orders": _churn_dataset(order_habits, order_listens),
    "churn_rate": _on(_churn_dataset(habits, cleaned), features.churn_rate),
    "churn_rate_orders": _on(_churn_dataset(order_habits, order_listens), features.churn_rate),
    "risk_band": _risk_band,
    # models
    "user_segments": _segments("user_segments"),
    "segmented_users": _without(_segments("user_segments"), "segment", "segment_label"),
    "segment_profiles": _segments("segment_profiles"),
    "users_per_segment": _on(_segments("segment_profiles"), questions.users_per_segment),
    "churn_predictions": _churn("churn_predictions"),
    "churn_predictions_orders": _order_churn("churn_predictions"),
    "scored_users": _without(_churn("churn_predictions"), "churn_probability", "risk_level"),
    "scored_users_orders": _without(
        _order_churn("churn_predictions"), "churn_probability", "risk_level"
    ),
    "churn_summary": _churn("churn_summary"),
    "churn_summary_orders": _order_churn("churn_summary"),
    "churn_risk_counts": _on(_churn("churn_predictions"), churn.churn_risk_counts),
    "churn_kpi": _on(_churn("churn_summary"), questions.churn_kpi),
    # models as tables
    "churn_scores_of_nodes": _of_nodes,
    "churn_importances": _importances,
    "churn_feature_auc": _feature_auc,
    "rule_forest_scores": _rule_scores,
    "segment_assignment": _of_centres,
    "nearest_plan": _nearest_plan,
    # catalog and SQL views
    "catalog_play_events": _sql(lambda db: db.table(catalog.BATCH_TABLE)),
    "catalog_streaming_events": _sql(lambda db: db.table(catalog.SPEED_TABLE)),
    "sql_top_songs": _sql(lambda db: db.top_songs()),
    "sql_top_artists": _sql(lambda db: db.top_artists()),
    "sql_plays_by_hour": _sql(lambda db: db.plays_by_hour()),
    "sql_level_stats": _sql(lambda db: db.level_stats()),
    "merged_events": _sql(lambda db: db.merged_events()),
    "merged_songs_by_source": _sql(lambda db: db.merged_songs()),
    "merged_artists_by_source": _sql(lambda db: db.merged_artists()),
    "records_by_source": _sql(lambda db: merge.records_by_source(db.merged_events())),
    "sql_text_top_songs": _sql_text("top_songs"),
    "sql_text_top_artists": _sql_text("top_artists"),
    "sql_text_plays_by_hour": _sql_text("plays_by_hour"),
    "sql_text_level_stats": _sql_text("level_stats"),
    "sql_top_songs_script": _on(raw, catalog.script_top_songs),
    "sql_top_artists_script": _on(raw, catalog.script_top_artists),
    "sql_plays_by_hour_ts": _on(raw, catalog.script_plays_by_hour),
    "sql_level_stats_script": _on(raw, catalog.script_level_stats),
    "merged_events_unfiltered": _merged_unfiltered,
    # speed views and merge
    "speed_top_songs": _on(speed, merge.speed_top_songs),
    "speed_top_artists": _on(speed, merge.speed_top_artists),
    "speed_active_ts": _on(speed, merge.speed_active_ts),
    "speed_level": _on(speed, merge.speed_level),
    "speed_summary": _speed_summary,
    "merged_top_songs": _merged_songs,
    "merged_top_artists": _merged_artists,
    "merged_active_ts": _merged_hours,
    # distinct users over both layers, from stored sets
    "merged_active_users_exact": _merged_sets(*_hour_sets, audience.merged_active_users),
    "merged_listeners_exact": _merged_sets("song_users", audience.song_users, audience.merged_listeners),
    "active_users_per_day": _merged_sets(
        *_hour_sets, lambda *both: audience.active_users_per(audience.merged(*both), "day")
    ),
    "active_users_per_month": _merged_sets(
        *_hour_sets, lambda *both: audience.active_users_per(audience.merged(*both), "month")
    ),
    "stickiness": _merged_sets(*_hour_sets, lambda *both: audience.stickiness(audience.merged(*both))),
    "merged_listeners_estimate": _merged_sets(
        "song_sketches", _song_sketches, lambda *both: audience.estimated(audience.merged(*both), "song", "artist")
    ),
    # tables written by whole batch and serving runs
    "stored_overview": _layers("store/overview"),
    "stored_top_songs": _layers("store/top_songs"),
    "stored_top_artists": _layers("store/top_artists"),
    "stored_plays_by_hour": _layers("store/plays_by_hour"),
    "stored_level_ratio": _layers("store/level_ratio"),
    "stored_session_dist": _layers("store/session_dist"),
    "stored_retention": _layers("store/retention"),
    "served_top10_songs": _layers("export/top10_songs"),
    "served_speed_summary": _layers("export/speed_summary"),
    "served_merged_top_songs": _layers("export/merged_top_songs"),
    "served_merged_top_artists": _layers("export/merged_top_artists"),
    "served_merged_active_ts": _layers("export/merged_active_ts"),
    "served_merged_active_users": _layers("export/merged_active_users"),
    "served_merged_listeners": _layers("export/merged_listeners"),
    # tables in buckets, joined without a shuffle
    "bucketed_churn_dataset": lambda spark, sf_dir: features.churn_dataset(*_dataset_tables(spark, sf_dir)),
    "bucketed_merged_songs": lambda spark, sf_dir: merge.merged_top_songs(*_song_tables(spark, sf_dir)),
    # bars from merged sketches
    "sketched_quartiles": lambda spark, sf_dir: features.sketched_quartiles(_cohort_sketches(spark, sf_dir)),
    "sketched_engagement_labels": _sketched_labels,
    # tables by day, after three landings
    "by_day_clean": _by_day(lambda days: days.clean()),
    "by_day_top_songs": _by_day(lambda days: views.top_songs(days.tracks())),
    "by_day_plays_by_hour": _by_day(lambda days: views.plays_by_hour(days.hours())),
    "by_day_first_play": _by_day(
        lambda days: days.first_days().withColumnRenamed("first_day", "first_play_date")
    ),
    "by_day_retention": _by_day(lambda days: days.retention()),
    # stream
    "stream_append": _stream_append("speed"),
    "stream_append_raw": _stream_append("raw"),
    "stream_window_top_songs": _stream_window,
    "window_top_songs": _window_batch,
    "stream_level_summary": _stream_level_summary,
    "stream_level_users": _stream_level_users,
    "stream_level_plays": _without(_stream_level_summary, "active_users", "unique_artists"),
    # keyed counts
    "count_by_artist_key": _on(plain, counts.count_by_artist_key),
    "count_by_hour_key": _on(plain, counts.count_by_hour_key),
    "count_by_user_key": _on(plain, counts.count_by_user_key),
    "bench_top_artists": _on(orders, counts.bench_top_artists),
    "bench_plays_by_hour": _on(orders, counts.bench_plays_by_hour),
    "bench_user_sessions": _on(orders, counts.bench_user_sessions),
    # dashboard questions
    "kpi_summary": _kpis,
    "funnel": _on(raw, questions.funnel),
    "at_risk_users": _at_risk,
    "live_feed": _on(speed, merge.live_feed),
    "hourly_by_layer": _hourly_by_layer,
    "top_artist": _on(cleaned, lambda df: questions.top_artist(views.top_artists(df))),
}


def registered() -> dict[str, Query]:
    """All queries, each pinning the session settings its results depend on."""

    def pinned(query: Query) -> Query:
        return lambda spark, sf_dir: query(sized(spark, sf_dir), sf_dir)

    return {name: pinned(query) for name, query in QUERIES.items()}
