import json
import time
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from playlake.schema import EVENT_COLUMNS, PAYLOAD_COLUMNS
from playlake.sources import files, messages
from playlake.streaming import plays as stream, progress
from tests.conftest import event, millis, rows

MESSAGE_DDL = "value STRING, timestamp TIMESTAMP"


def text(**fields) -> str:
    record = event(**fields)
    return json.dumps({c: record.get(c) for c in PAYLOAD_COLUMNS})


@pytest.fixture
def topic(spark, tmp_path):
    """A folder of message files, one micro-batch per file, oldest first."""
    folder = tmp_path / "topic"
    folder.mkdir()

    def send(*values: str) -> None:
        n = len(list(folder.glob("*.json")))
        lines = [json.dumps({"value": v, "timestamp": "2024-01-01T10:00:00Z"}) for v in values]
        staged = tmp_path / f"{n}.staged"
        staged.write_text("\n".join(lines))
        time.sleep(0.01)
        (folder / f"{n:03d}.json").write_text(staged.read_text())

    def read():
        raw = spark.readStream.schema(MESSAGE_DDL).option("maxFilesPerTrigger", 1).json(str(folder))
        return stream.parsed_events(raw)

    return send, read, str(tmp_path)


def at(minute: int, second: int = 0) -> str:
    return f"2024-01-01 10:{minute:02d}:{second:02d}"


def test_ingest_lands_raw_and_speed(spark, topic):
    send, read, base = topic
    send(text(), text(page="Home", artist=None, song=None), text(userId=None), "{broken", "")
    stream.start_ingest(read(), f"{base}/raw", f"{base}/speed", f"{base}/cp", None).awaitTermination()
    raw, speed = files.read_events(spark, f"{base}/raw"), files.read_events(spark, f"{base}/speed")
    assert raw.columns == EVENT_COLUMNS
    assert rows(raw, "page", "userId") == [("Home", 1), ("NextSong", 1), ("NextSong", None)]
    assert rows(speed, "page", "userId", "artist") == [("NextSong", 1, "A")]
    assert speed.first()["event_ts"] == datetime(2024, 1, 1, 10)
    assert speed.filter("ingestion_time is null or kafka_timestamp is null").count() == 0


def test_restart_continues_without_copies(spark, topic):
    send, read, base = topic
    ingest = lambda: stream.start_ingest(
        read(), f"{base}/raw", f"{base}/speed", f"{base}/cp", None
    ).awaitTermination()
    send(text(song="one"))
    ingest()
    ingest()
    send(text(song="two"))
    send(text(song="three"))
    ingest()
    assert rows(files.read_events(spark, f"{base}/raw"), "song") == [("one",), ("three",), ("two",)]


def test_repeated_batch_overwrites_itself(spark, events, tmp_path):
    write = stream._write_layers(f"{tmp_path}/raw", f"{tmp_path}/speed")
    batch = events(event(), event(userId=2))
    write(batch, 7)
    write(batch, 7)
    write(batch, 8)
    assert files.read_events(spark, f"{tmp_path}/raw").count() == 4


def test_second_checkpoint_adds_and_never_replaces(spark, topic):
    send, read, base = topic
    send(text(song="one"))
    for checkpoint in ("first", "second"):
        stream.start_ingest(read(), f"{base}/raw", f"{base}/speed", f"{base}/{checkpoint}", None).awaitTermination()
    assert rows(files.read_events(spark, f"{base}/raw"), "song") == [("one",), ("one",)]
    landed = files.read_landed(spark, f"{base}/speed")
    assert landed.select("run").distinct().count() == 2
    assert rows(landed, "batch_id") == [(0,), (0,)]


def test_append_sink(spark, topic):
    send, read, base = topic
    send(text(song="one"))
    send(text(song="two"))
    for _ in range(2):
        stream.start_append(stream.song_plays(read()), f"{base}/out", f"{base}/cp", None).awaitTermination()
    assert rows(files.read_events(spark, f"{base}/out"), "song") == [("one",), ("two",)]


def test_windows_drop_late_rows_and_hold_open_ones(spark, topic):
    send, read, base = topic
    # Lateness is judged by the watermark of the batch before.
    send(*[text(at=at(m)) for m in range(11)])
    send(text(at=at(11)))
    send(text(at=at(1)), text(at=at(20)))
    query = stream.start_window(read(), f"{base}/out", f"{base}/cp", None)
    query.awaitTermination()
    dropped = sum(
        op.numRowsDroppedByWatermark for p in query.recentProgress for op in p.stateOperators
    )
    assert dropped == 1
    out = files.read_view(spark, f"{base}/out")
    emitted = [(r["window_start"], r["play_count"]) for r in out.orderBy("window_start").collect()]
    assert emitted == [(datetime(2024, 1, 1, 10, m), 1) for m in range(12)]


def test_closed_windows_equal_the_batch_twin(spark, topic):
    send, read, base = topic
    values = [text(at=at(m, s), song=f"s{s % 2}", duration=float(s)) for m in range(9) for s in (1, 30, 59)]
    send(*values)
    stream.start_window(read(), f"{base}/out", f"{base}/cp", None).awaitTermination()
    frame = spark.createDataFrame([(v, None) for v in values], MESSAGE_DDL)
    twin = stream.songs_per_window(stream.song_plays(stream.parsed_events(frame)))
    closed = twin.filter(F.col("window_end") <= F.lit(at(6, 59)).cast("timestamp"))
    assert rows(files.read_view(spark, f"{base}/out")) == rows(closed)


def test_level_summary_keeps_the_latest_totals(spark, topic):
    send, read, base = topic
    send(text(), text(userId=2, level="paid"))
    send(text(userId=3), text(userId=3, artist="B"))
    stream.start_level_summary(read(), f"{base}/cp", f"{base}/out", None).awaitTermination()
    assert rows(files.read_view(spark, f"{base}/out")) == [("free", 3, 2, 2), ("paid", 1, 1, 1)]


def test_console_summary_runs(topic):
    send, read, base = topic
    send(text())
    stream.start_level_summary(read(), f"{base}/cp", every=None).awaitTermination()


def test_interval_trigger_and_stop_all(spark, topic):
    send, read, base = topic
    send(text())
    query = stream.start_ingest(read(), f"{base}/raw", f"{base}/speed", f"{base}/cp", "1 second")
    query.processAllAvailable()
    query.stop()
    stream.run_until_stopped(spark, [query])
    assert not query.isActive
    assert files.read_events(spark, f"{base}/speed").count() == 1


def test_messages_round_trip(events):
    df = events(event(kafka_timestamp="2024-01-01 10:00:01"), event(artist=None, duration=None))
    back = messages.parse_messages(messages.to_messages(df))
    assert rows(back) == rows(df, *PAYLOAD_COLUMNS, "kafka_timestamp")


def test_parse_fills_missing_and_ignores_extra_fields(spark):
    good = json.dumps({"page": "Home", "ts": millis("2024-01-01 00:00:00"), "mood": "happy"})
    df = spark.createDataFrame([(good, None), ("nonsense", None), (None, None)], MESSAGE_DDL)
    parsed = messages.parse_messages(df)
    assert parsed.columns == [*PAYLOAD_COLUMNS, "kafka_timestamp"]
    assert rows(parsed, "page", "artist") == [("Home", None), (None, None), (None, None)]
    assert stream.parsed_events(df).count() == 1


def test_kafka_source_options(spark):
    options = messages.kafka_options("broker:9092")
    assert options["subscribe"] == "music-events"
    assert options["startingOffsets"] == "earliest" and options["failOnDataLoss"] == "false"
    with pytest.raises(Exception, match="(?i)kafka"):  # the connector is not on this class path
        messages.kafka_messages(spark, "broker:9092")


def test_progress_table_counts_late_rows(spark, topic):
    send, read, base = topic
    send(*[text(at=at(m)) for m in range(11)])
    send(text(at=at(11)))
    send(text(at=at(1)), text(at=at(2), song="other"), text(at=at(20)))
    send(text(at=at(21)))
    with progress.ProgressTable(spark, f"{base}/progress", flush_rows=2):
        stream.start_window(read(), f"{base}/out", f"{base}/cp", None).awaitTermination()
        stream.start_append(stream.song_plays(read()), f"{base}/plain", f"{base}/cp2", None).awaitTermination()
        for _ in range(100):  # the listener hears of a batch after its query has ended
            if progress_is_complete(spark, f"{base}/progress"):
                break
            time.sleep(0.2)
    table = progress.read_progress(spark, f"{base}/progress")
    per_query = sorted(tuple(r)[1:] for r in progress.late_rows(table).collect())
    windows, plain = sorted(per_query, key=lambda r: -r[2])
    assert plain[2:] == (0, 0) and plain[1] == 16
    assert windows[1] == 16 and windows[2] == 2 and windows[3] > 0
    stateful = table.filter("operator is not null")
    assert stateful.filter("late_rows > 0").select("operator_name").distinct().count() == 1
    assert stateful.filter("state_rows < 0 or state_bytes <= 0").count() == 0


def progress_is_complete(spark, path) -> bool:
    """Whether both queries' input shows in the table."""
    try:
        held = progress.late_rows(progress.read_progress(spark, path)).agg(F.sum("input_rows")).first()[0]
    except Exception:  # nothing written yet
        return False
    return held == 32


def test_a_batch_run_again_counts_once(spark, tmp_path):
    row = ("q", "r", None, 3, "2024-01-01T00:00:00Z", 0, "stateStoreSave", 5, 2, 1, 1, 10, None)
    again = ("q", "r2", None, 3, "2024-01-01T00:00:09Z", 0, "stateStoreSave", 5, 2, 1, 2, 10, None)
    for piece, rows_ in enumerate(([row], [again])):
        spark.createDataFrame(rows_, progress.PROGRESS_DDL).write.parquet(f"{tmp_path}/piece={piece}")
    assert rows(progress.late_rows(progress.read_progress(spark, str(tmp_path)))) == [("q", 1, 5, 2, 2)]


def test_level_sets_count_users_exactly(spark, topic):
    send, read, base = topic
    send(text(), text(userId=2, level="paid"))
    send(text(userId=3), text(userId=3, artist="B"))
    run = lambda: stream.start_level_sets(read(), f"{base}/sets", f"{base}/cp3", None).awaitTermination()
    run()
    assert rows(stream.level_users(spark, f"{base}/sets"), "level", "active_users", "plays") == [("free", 2, 3), ("paid", 1, 1)]
    send(text(userId=3), text(userId=9))
    run()
    assert rows(stream.level_users(spark, f"{base}/sets"), "level", "active_users", "plays") == [("free", 3, 5), ("paid", 1, 1)]
