import sys
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from playlake.schema import EVENT_COLUMNS, EVENT_DDL  # noqa: E402
from playlake.session import prepare  # noqa: E402

TINY = "/root/testdata/sf0.001"
SMALL = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "6g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield prepare(session)
    session.stop()


def millis(text: str) -> int:
    """Epoch milliseconds of a UTC time."""
    moment = datetime.fromisoformat(text + "+00:00")
    return round(moment.timestamp() * 1000)


def event(at: str | None = "2024-01-01 10:00:00", **fields) -> dict:
    """One play event with defaults; times are UTC text, given as naive datetimes."""
    base = {
        "artist": "A",
        "song": "s",
        "duration": 100.0,
        "ts": None if at is None else millis(at),
        "userId": 1,
        "sessionId": 1,
        "page": "NextSong",
        "level": "free",
        "location": "City, ST",
    }
    return {**base, **fields}


@pytest.fixture(scope="session")
def events(spark):
    """Build an event frame; event_ts is filled from ts unless given."""

    def build(*rows: dict):
        from pyspark.sql import functions as F

        texts = ("event_ts", "kafka_timestamp", "ingestion_time")
        ddl = EVENT_DDL.replace("TIMESTAMP", "STRING")
        data = [tuple(row.get(c) for c in EVENT_COLUMNS) for row in rows]
        frame = spark.createDataFrame(data, ddl)
        for name in texts:
            frame = frame.withColumn(name, F.col(name).cast("timestamp"))
        return frame

    return build


@pytest.fixture(scope="session")
def plays(events):
    """Like ``events``, with event_ts already filled."""
    from playlake.operators.clean import fill_event_time

    return lambda *rows: fill_event_time(events(*rows))


def rows(df, *columns):
    """Rows as a sorted list of tuples."""
    chosen = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in chosen.collect()), key=repr)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
