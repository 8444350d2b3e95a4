"""What the text operators share: row numbers, texts in Arrow batches, stored steps."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from playlake.session import fresh_dir

BATCH_ROWS = 1000
BATCH_BYTES = 8 << 20
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SPACES = " \t\n\x0b\x0c\r"  # what [^\x20\x09-\x0D]+ leaves out


def small_batches(spark: SparkSession) -> None:
    """Hand rows to Python in batches bounded by bytes as well as by rows.

    Scans are cut alike from here on: unless told, Spark cuts small files by the
    cores it has at the moment, so an executor lost between two scans of a table
    would move its row numbers.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    least = "spark.sql.files.minPartitionNum"
    if not spark.conf.get(least, None):
        spark.conf.set(least, str(spark.sparkContext.defaultParallelism))


def numbered(table: DataFrame) -> DataFrame:
    """(rid, doc_id, text) of a stored table; a null text counts as empty.

    ``rid`` is the place of a row in the scan, so that repeated ids and repeated
    rows stay apart. A lost task that reads the same file range again gives the
    same numbers, so ``table`` has to be a scan, not the result of a shuffle.
    Other columns are left unread.
    """
    return table.select(
        F.monotonically_increasing_id().alias("rid"),
        "doc_id",
        F.coalesce("text", F.lit("")).alias("text"),
    )


def stored(frame: DataFrame, name: str) -> DataFrame:
    """Write a step to the shared folder and read it back: lineage ends here.

    As zstd, like the tables of events: the steps hold texts and hashes, and stand on disk
    beside the shuffles until the query ends.
    """
    spark = frame.sparkSession
    path = fresh_dir(spark, name)
    frame.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def remainder(doc_id, parts: int):
    """crc32 of the id as text, modulo ``parts``; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % parts


def texts(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    """The texts of a batch as UTF-8."""
    found = batch.column(column)
    if not pa.types.is_binary(found.type):
        found = found.cast(pa.large_binary() if pa.types.is_large_string(found.type) else pa.binary())
    return found.to_pylist()


def with_columns(
    batch: pa.RecordBatch, keep: list[str], columns: dict[str, pa.Array]
) -> pa.RecordBatch:
    """The kept columns of a batch and new ones."""
    return pa.RecordBatch.from_arrays(
        [batch.column(c) for c in keep] + list(columns.values()), keep + list(columns)
    )


def map_batches(
    frame: DataFrame, work: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str
) -> DataFrame:
    """``mapInArrow`` for work that needs one batch at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield work(batch)

    return frame.mapInArrow(run, schema)


def packed(table: DataFrame) -> DataFrame:
    """(rid, row): a table's rows as one column each, safe from clashing names."""
    return table.select(
        F.monotonically_increasing_id().alias("rid"),
        F.struct(*[F.col(f"`{c}`") for c in table.columns]).alias("row"),
    )


def unpacked(frame: DataFrame, table: DataFrame) -> DataFrame:
    """The columns of ``table`` from (row, text), with ``text`` and ``n_chars`` anew."""
    fresh = {"text": F.col("text")}
    if "n_chars" in table.columns:
        changed = ~F.col("text").eqNullSafe(F.col("row.text"))
        count = F.length("text").cast(table.schema["n_chars"].dataType)
        fresh["n_chars"] = F.when(changed, count).otherwise(F.col("row.n_chars"))
    return frame.select(*[fresh.get(c, F.col(f"row.`{c}`")).alias(c) for c in table.columns])
