import threading
from functools import partial

import pytest
from pyspark.sql import functions as F

from checks import queries
from playlake import fixed
from playlake.__main__ import main
from playlake.operators import clean, views
from playlake.plans.batch import run_batch
from playlake.plans.incremental import DayStore
from playlake.plans.serving import load_catalog, run_serving
from playlake.schema import EVENT_COLUMNS
from playlake.session import CHECKPOINT_SETTING, fresh_dir, shared_dir, shuffles_for, size_for, task_layout, together
from playlake.sources import catalog, files, testdata
from tests.conftest import SMALL, TINY, event, rows


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("store"))
    raw = testdata.raw_events(spark, SMALL).filter(testdata.speed_start(batch=True))
    files.write_parquet(raw, f"{base}/raw/run=a/batch_id=0")
    written = run_batch(spark, f"{base}/raw", f"{base}/store")
    held = testdata.event_plays(spark, SMALL).filter("page = 'NextSong' and ts >= 1705708800000")
    # From 2024-01-20 on: the first micro-batch is in the batch layer, too.
    files.write_parquet(held.filter(testdata.speed_start(batch=True)), f"{base}/speed/run=a/batch_id=0")
    newer = held.filter(testdata.speed_start(batch=False))
    odd = newer.limit(1).withColumn("ts", F.explode(F.array(F.lit(0), F.lit(4102444800000), F.lit(None))))
    files.write_parquet(newer.unionByName(odd.select(*newer.columns)), f"{base}/speed/run=a/batch_id=1")
    return base, written


def test_batch_run_writes_every_view(spark, store):
    base, written = store
    for name in fixed.PUBLISHED_VIEWS:
        assert files.read_view(spark, f"{base}/store/{name}").columns
    clean = files.read_events(spark, f"{base}/store/clean")
    assert written["clean"] == clean.count()
    raw = files.read_events(spark, f"{base}/raw").count()
    assert (written["raw"], written["dropped"]) == (raw, raw - clean.count())
    assert rows(files.read_view(spark, f"{base}/store/top_songs")) == rows(views.top_songs(clean))
    assert rows(files.read_view(spark, f"{base}/store/retention")) == rows(views.retention(clean))
    assert files.read_view(spark, f"{base}/store/top10_songs").count() == 10
    assert files.read_view(spark, f"{base}/store/page_dist").count() == 6


def test_serving_without_overlap_counts_each_play_once(spark, store):
    base, _ = store
    written = run_serving(spark, f"{base}/store", f"{base}/speed", f"{base}/export")
    assert all(written[name] is not None for name in fixed.PUBLISHED_VIEWS)
    merged = files.read_view(spark, f"{base}/export/merged_top_songs")
    total = merged.agg(F.sum("merged_plays")).first()[0]
    row = files.read_view(spark, f"{base}/export/speed_summary").first()
    assert total == 5969 + 3  # a late, a future-dated and an undated event
    hours = files.read_view(spark, f"{base}/export/merged_active_ts")
    assert hours.agg(F.sum("total_plays")).first()[0] == 5969 + 3
    assert row["stream_total"] == files.read_events(spark, f"{base}/speed").count()


def test_latest_arrival_is_a_time_right_after_a_batch_run(spark, events, tmp_path):
    landed = events(event(ingestion_time="2024-01-01 10:00:02"))
    for layer in ("raw", "speed"):
        files.write_parquet(landed, f"{tmp_path}/{layer}/run=a/batch_id=0")
    run_batch(spark, f"{tmp_path}/raw", f"{tmp_path}/store", models=False)
    run_serving(spark, f"{tmp_path}/store", f"{tmp_path}/speed", f"{tmp_path}/export")
    row = files.read_view(spark, f"{tmp_path}/export/speed_summary").first()
    assert (row["stream_total"], row["latest_ingestion"]) == (1, "2024-01-01 10:00:02")
    merged = files.read_view(spark, f"{tmp_path}/export/merged_top_songs")
    assert [r["merged_plays"] for r in merged.collect()] == [1]


def test_broken_speed_table_raises(spark, store, tmp_path):
    base, _ = store
    (tmp_path / "speed").mkdir()
    (tmp_path / "speed" / "part-0.parquet").write_text("not a table")
    with pytest.raises(Exception, match="part-0"):
        run_serving(spark, f"{base}/store", str(tmp_path / "speed"), str(tmp_path / "export"))


def test_serving_with_overlap_adds_all_speed_rows(spark, store):
    base, _ = store
    run_serving(spark, f"{base}/store", f"{base}/speed", f"{base}/export2", overlap=True)
    row = files.read_view(spark, f"{base}/export2/speed_summary").first()
    assert row["stream_total"] == files.read_events(spark, f"{base}/speed").count()


def test_serving_before_the_stream_has_started(spark, store):
    base, _ = store
    run_serving(spark, f"{base}/store", f"{base}/nowhere", f"{base}/export3")
    row = files.read_view(spark, f"{base}/export3/speed_summary").first()
    assert row["stream_total"] == 0 and row["latest_ingestion"] == "N/A"
    merged = files.read_view(spark, f"{base}/export3/merged_top_songs")
    assert merged.filter("merged_plays != play_count").count() == 0


def test_publish_skips_missing_views(spark, store, tmp_path):
    base, _ = store
    copied = files.publish(spark, f"{base}/store", str(tmp_path), ["overview", "no_such_view"])
    assert copied == {"overview": 1, "no_such_view": None}


def test_catalog_round_trip(spark, store):
    base, _ = store
    db = load_catalog(
        spark, "lake_test", f"{base}/store/clean", f"{base}/speed", fresh_dir(spark, "db")
    )
    clean = files.read_events(spark, f"{base}/store/clean")
    assert db.table("play_events").columns == EVENT_COLUMNS
    assert rows(db.table("plays_by_hour")) == rows(views.plays_by_hour(clean))
    assert db.preview("top_songs").count() == 10
    db.use()
    both = spark.sql("SELECT data_source, count(*) AS n FROM merged_events GROUP BY data_source")
    assert {r[0] for r in both.collect()} == {"batch", "stream"}
    again = db.top_songs()  # replacing a table keeps its rows
    assert again.count() == db.table("top_songs").count()
    assert db.merged_events(filter_batch=False).count() == db.merged_events().count()
    spark.sql("USE default")


def test_external_table_over_stream_folders(spark, events, tmp_path):
    for n in (0, 1):
        files.write_parquet(events(event(userId=n)), f"{tmp_path}/speed/batch_id={n}")
    db = catalog.Catalog(spark, "lake_folders", fresh_dir(spark, "db"))
    got = db.streaming_events(f"{tmp_path}/speed", "batch_id BIGINT")
    assert rows(got, "userId") == [(0,), (1,)]
    db.play_events(f"{tmp_path}/speed/batch_id=0")
    assert db.merged_events().count() == 3


def test_dropping_an_external_table_keeps_its_files(spark, events, tmp_path):
    files.write_parquet(events(event()), f"{tmp_path}/clean")
    db = catalog.Catalog(spark, "lake_drop", fresh_dir(spark, "db"))
    db.play_events(f"{tmp_path}/clean")
    spark.sql("DROP TABLE lake_drop.play_events")
    assert files.read_events(spark, f"{tmp_path}/clean").count() == 1


def test_guard(spark, events, tmp_path):
    with pytest.raises(files.NoEventsError):
        files.require_events(spark, f"{tmp_path}/missing")
    files.write_parquet(events(), f"{tmp_path}/empty")
    with pytest.raises(files.NoEventsError):
        files.require_events(spark, f"{tmp_path}/empty")
    files.write_parquet(events(event()), f"{tmp_path}/some")
    assert files.require_events(spark, f"{tmp_path}/some").count() == 1


def test_write_counts_and_overwrites(spark, events, tmp_path):
    path = f"{tmp_path}/t"
    assert files.write_parquet(events(event(), event()).repartition(4), path) == 2
    assert files.write_parquet(events(event()).repartition(4), path, single_file=True) == 1
    assert len(list((tmp_path / "t").glob("*.parquet"))) == 1


def test_malformed_json_lines_are_skipped(spark, tmp_path):
    (tmp_path / "j").mkdir()
    lines = ['{"artist": "A", "ts": 1, "mood": 3}', "{oops", '{"userId": "text"}', ""]
    (tmp_path / "j" / "part.json").write_text("\n".join(lines))
    df = files.read_json_events(spark, str(tmp_path / "j"))
    assert df.columns == EVENT_COLUMNS
    assert rows(df.select("artist", "ts", "userId")) == [("A", 1, None)]
    assert rows(df, "artist", "ts") == [("A", 1), (None, None)]  # userId is not read here
    assert df.filter("artist = 'A'").count() == 1


def test_shared_folder_follows_the_setting(spark):
    root = spark.conf.get(CHECKPOINT_SETTING)
    assert shared_dir(spark, "x") == f"{root}/playlake/x"
    assert fresh_dir(spark, "x") != fresh_dir(spark, "x")


def test_flat_and_stream_sources_map_alike(spark):
    stream = testdata.event_stream(spark, TINY)
    assert stream.isStreaming
    assert stream.schema.simpleString() == testdata.event_plays(spark, TINY).schema.simpleString()


def test_task_layout_grows_tasks_only_beyond_the_limit():
    assert task_layout(1) == (1, 128 << 20)
    assert task_layout(1 << 40) == (8192, 128 << 20)
    tasks, size = task_layout(100 * 10**12)
    assert tasks <= 32_768 and tasks * size >= 100 * 10**12 and size < 4 << 30


def test_sizing_never_lowers_the_setting(spark):
    initial = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    splits = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(splits)
    try:
        size_for(spark, 10 << 30)
        assert spark.conf.get(initial) == "80"
        size_for(spark, 1)
        assert spark.conf.get(initial) == spark.conf.get("spark.sql.shuffle.partitions")
    finally:
        spark.conf.unset(initial)
        spark.conf.set(splits, before)


def test_shuffles_grow_with_the_tables(spark):
    initial = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    splits = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        shuffles_for(spark, 512 << 20)
        assert spark.conf.get(initial) == "128"
        assert spark.conf.get("spark.sql.files.maxPartitionBytes") == splits
        shuffles_for(spark, 6 * 512 << 20)
        assert spark.conf.get(initial) == "768"
    finally:
        spark.conf.unset(initial)


@pytest.mark.parametrize(
    ("plays", "key", "other"), [(testdata.order_plays, "sessionId", "userId"), (testdata.raw_events, "userId", "sessionId")]
)
def test_plays_are_cleaned_where_they_were_joined(spark, plays, key, other):
    """No wide row is moved again for its deduplication."""
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        plan = clean.clean_events(plays(spark, TINY))._jdf.queryExecution().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    physical = plan[plan.index("== Physical Plan ==") :]
    moved = [line for line in physical.splitlines() if "Exchange hashpartitioning(" in line]
    assert sum(f"hashpartitioning({key}" in line for line in moved) == 2
    assert not any("hashpartitioning(ts" in line or f"hashpartitioning({other}" in line for line in moved)


def test_command_line(spark, store, tmp_path):
    base, _ = store
    out = str(tmp_path)
    main(["batch", "--raw", f"{base}/raw", "--store", f"{out}/store", "--no-models"])
    main(["serve", "--store", f"{out}/store", "--speed", f"{base}/speed", "--export", f"{out}/export"])
    main(["export-json", "--clean", f"{out}/store/clean", "--json", f"{out}/json"])
    main(["counts", "--json", f"{out}/json", "--out", f"{out}/counts"])
    clean = files.read_events(spark, f"{out}/store/clean")
    by_artist = files.read_view(spark, f"{out}/counts/top_artists")
    assert by_artist.agg(F.sum("count")).first()[0] == clean.count()
    assert files.read_view(spark, f"{out}/counts/artist_keys").columns == ["key", "n"]
    spark.sql("USE default")
    main([
        "catalog", "--database", "lake_cli", "--location", fresh_dir(spark, "db"),
        "--clean", f"{out}/store/clean", "--speed", f"{base}/speed", "--flat-speed",
    ])
    assert spark.table("lake_cli.merged_top_songs").count() > 0


def test_nightly_command_and_the_run_by_day(spark, store, tmp_path):
    base, _ = store
    out = str(tmp_path)
    spark.sql("USE default")
    main([
        "nightly", "--raw", f"{base}/raw", "--store", f"{out}/store", "--speed", f"{base}/speed", "--no-models",
        "--export", f"{out}/export", "--database", "lake_night", "--location", fresh_dir(spark, "db"),
    ])
    clean = files.read_events(spark, f"{out}/store/clean")
    assert spark.table("lake_night.play_events").count() == clean.count()
    assert rows(files.read_view(spark, f"{out}/export/merged_top_songs")) == rows(
        files.read_view(spark, f"{base}/export/merged_top_songs")
    )
    main(["by-day", "--raw", f"{base}/raw", "--store", f"{out}/days"])
    assert rows(DayStore(spark, f"{out}/days").clean()) == rows(clean)


def test_steps_that_do_not_need_each_other_run_at_the_same_time(spark):
    """Each waits for the other, which in a row would never end."""
    met = threading.Barrier(2)

    def step(number: int) -> int:
        met.wait(timeout=20)
        return spark.range(number).count()

    assert together(spark, {"a": partial(step, 3), "b": partial(step, 5)}) == {"a": 3, "b": 5}
    with pytest.raises(ZeroDivisionError):
        together(spark, {"a": partial(spark.range(1).count), "b": lambda: 1 // 0})


def test_layers_are_landed_in_one_write(spark, monkeypatch):
    """The mapped events are not stored on their way to the two layers, which hold what they held."""
    monkeypatch.setattr(queries, "_tables", {})
    assert queries.QUERIES["served_merged_active_users"](spark, TINY).count()
    names = {name: path for (_, _, name), path in queries._tables.items()}
    assert set(names) == {"layers"}
    source = testdata.event_plays(spark, TINY)
    older, newer = source.filter(testdata.speed_start(batch=True)), source.filter(testdata.speed_start(batch=False))
    for expected, layer in ((older, "raw"), (clean.drop_incomplete(clean.filter_page(newer)), "speed")):
        landed = files.read_events(spark, f"{names['layers']}/{layer}")
        assert landed.exceptAll(expected).isEmpty()
        assert expected.exceptAll(landed).isEmpty()
