"""What a stream did, batch by batch, as a table: input, state, and rows too late for the watermark.

A watermark drops rows without a trace in the output. The listener here keeps one row
per batch and stateful operator of every query of the session, and writes them out in
pieces, so that dropped rows and the growth of state can be watched and summed with SQL.
"""

from __future__ import annotations

import threading
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQueryListener

PROGRESS_DDL = (
    "query STRING, run STRING, name STRING, batch_id BIGINT, at STRING, operator INT, operator_name STRING, "
    "input_rows BIGINT, state_rows BIGINT, updated_rows BIGINT, late_rows BIGINT, state_bytes BIGINT, watermark STRING"
)
FLUSH_ROWS = 100


def progress_rows(progress) -> list[tuple]:
    """One row per stateful operator of a batch, or one for a batch that has none."""
    head = (str(progress.id), str(progress.runId), progress.name, progress.batchId, progress.timestamp)
    watermark = dict(progress.eventTime).get("watermark")
    some = [
        (n, o.operatorName, progress.numInputRows, o.numRowsTotal, o.numRowsUpdated, o.numRowsDroppedByWatermark, o.memoryUsedBytes)
        for n, o in enumerate(progress.stateOperators)
    ]
    return [(*head, *row, watermark) for row in some or [(None, None, progress.numInputRows, None, None, None, None)]]


class ProgressTable(StreamingQueryListener):
    """Keeps the progress of all queries below ``path``; use it as a context around them.

    Rows are written every FLUSH_ROWS rows, when a query ends and when the context is
    left, each time as a file of its own.
    """

    def __init__(self, spark: SparkSession, path: str, flush_rows: int = FLUSH_ROWS):
        self.spark, self.path, self.flush_rows = spark, path, flush_rows
        self._rows: list[tuple] = []
        self._lock = threading.Lock()

    def __enter__(self) -> ProgressTable:
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *_) -> None:
        self.spark.streams.removeListener(self)
        self.flush()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        with self._lock:
            self._rows += progress_rows(event.progress)
            full = len(self._rows) >= self.flush_rows
        if full:
            self.flush()

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.flush()

    def flush(self) -> None:
        """Write what has come in since the last time."""
        with self._lock:
            rows, self._rows = self._rows, []
        if rows:
            frame = self.spark.createDataFrame(rows, PROGRESS_DDL).coalesce(1)
            frame.write.parquet(f"{self.path}/piece={uuid.uuid4().hex}")


def read_progress(spark: SparkSession, path: str) -> DataFrame:
    """All rows kept so far; a batch that was run again shows with its last row only."""
    held = spark.read.schema(f"{PROGRESS_DDL}, piece STRING").parquet(path).drop("piece")
    keys = ["query", "batch_id", "operator"]
    rest = [c for c in held.columns if c not in (*keys, "at")]
    last = F.max(F.struct("at", *rest)).alias("last")
    return held.groupBy(*keys).agg(last).select(*keys, "last.*").select(*held.columns)


def late_rows(progress: DataFrame) -> DataFrame:
    """(query, batches, input_rows, late_rows, state_rows): rows dropped as too late, and the state in the end."""
    per_batch = progress.groupBy("query", "batch_id").agg(
        F.max("input_rows").alias("input_rows"), F.sum("late_rows").alias("late_rows"), F.sum("state_rows").alias("state_rows")
    )
    return per_batch.groupBy("query").agg(
        F.count(F.lit(1)).alias("batches"),
        F.sum("input_rows").alias("input_rows"),
        F.coalesce(F.sum("late_rows"), F.lit(0)).alias("late_rows"),
        F.coalesce(F.max_by("state_rows", "batch_id"), F.lit(0)).alias("state_rows"),
    )
