"""Parquet and JSON tables of play events and views."""

from __future__ import annotations

import logging
from functools import partial

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from playlake.schema import EVENT_COLUMNS, EVENT_DDL
from playlake.session import together
from playlake.sources.versions import read_version, write_version

log = logging.getLogger(__name__)

# The folders of a stream's output: the stream query, and its micro-batch.
LANDED_DDL = "run STRING, batch_id BIGINT"
# Six digits: the default would cut microseconds.
JSON_TIME = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


class NoEventsError(RuntimeError):
    """The raw folder is missing or holds no event."""


def read_events(spark: SparkSession, path: str) -> DataFrame:
    """Event table with the declared schema; no footer or data is read to infer it.

    Folder columns of the layout (a date, a stream batch) are left out.
    """
    return spark.read.schema(EVENT_DDL).parquet(path).select(*EVENT_COLUMNS)


def read_landed(spark: SparkSession, path: str) -> DataFrame:
    """Event table with the folders a stream wrote it to (null without such folders)."""
    return spark.read.schema(f"{EVENT_DDL}, {LANDED_DDL}").parquet(path)


def is_missing(error: AnalysisException) -> bool:
    """Whether a read failed because there is no such path, and for no other reason."""
    return error.getCondition() == "PATH_NOT_FOUND"


def no_events(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], EVENT_DDL)


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of all files below a folder, from their listing; no file is opened."""
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return listing.agg(F.sum("length")).first()[0] or 0


def read_view(spark: SparkSession, path: str) -> DataFrame:
    """Any Parquet table with the schema of its footer; of a versioned one, the current version."""
    return read_version(spark, path)


def read_json_events(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines with the declared schema; malformed lines are skipped.

    Only the columns a query uses are parsed, so a value of the wrong type
    makes a line malformed for the queries that read that column.
    """
    reader = spark.read.schema(EVENT_DDL).option("mode", "DROPMALFORMED")
    return reader.option("timestampFormat", JSON_TIME).json(path)


def require_events(spark: SparkSession, path: str) -> DataFrame:
    """Raw events, or :class:`NoEventsError` when there are none yet."""
    try:
        # Listed here, not at the first action, so that a missing folder shows.
        raw = read_events(spark, path)
        empty = raw.isEmpty()
    except AnalysisException as missing:
        if not is_missing(missing):
            raise
        raise NoEventsError(f"no event files below {path}") from missing
    if empty:
        raise NoEventsError(f"no events in {path}")
    return raw


def write_parquet(df: DataFrame, path: str, single_file: bool = False) -> int:
    """Overwrite ``path`` and return the number of rows written.

    The count is observed while writing, not by a second scan. Without
    ``single_file``, which is for results known to be tiny, every task writes
    its own file.
    """
    counted = Observation()
    out = df.observe(counted, F.count(F.lit(1)).alias("rows"))
    if single_file:
        out = out.coalesce(1)
    out.write.mode("overwrite").parquet(path)
    return counted.get["rows"]


def write_json(df: DataFrame, path: str) -> None:
    """Overwrite ``path`` with JSON lines, one file per task."""
    df.write.mode("overwrite").option("timestampFormat", JSON_TIME).json(path)


def publish(spark: SparkSession, store: str, target: str, names: list[str]) -> dict[str, int | None]:
    """Copy stored views to the place readers use: name -> rows, None if missing.

    Each becomes a new version of its table, so readers see the old or the new one whole.
    """
    def copy(name: str) -> int | None:
        try:
            view = read_view(spark, f"{store}/{name}")
        except AnalysisException as missing:
            if not is_missing(missing):
                raise
            log.warning("no stored view %s below %s: not published", name, store)
            return None
        return write_version(view, f"{target}/{name}")

    return together(spark, {name: partial(copy, name) for name in names})
