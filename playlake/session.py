"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

MIN_TASK_BYTES = 128 << 20
MAX_TASKS = 32_768
AT_ONCE = 6  # steps of a run whose jobs are handed to Spark at the same time
WIDENED = 32  # 36 million order lines: 13 bytes each in their file, some 400 as joined rows
STORED_WIDENED = 16  # events stored as zstd: some 25 bytes each, some 400 as rows
SHUFFLED_WIDENED = 8  # the same rows in shuffle blocks: some 45 bytes each
CHECKPOINT_SETTING = "spark.checkpoint.dir"
_local_roots: dict[str, str] = {}


def prepare(spark: SparkSession) -> SparkSession:
    """Pin what results depend on (UTC), keep adaptive execution on, and write tables as zstd.

    Partition counts are left to the cluster's settings and to adaptive
    coalescing; nothing here is sized for one machine.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    spark.conf.set("spark.sql.parquet.compression.codec", "zstd")
    return spark


def task_layout(input_bytes: int) -> tuple[int, int]:
    """(tasks, bytes per task) for a scan or full shuffle of ``input_bytes``.

    Tasks of 128 MiB up to 4 TiB; above that the tasks grow, because the blocks
    of a shuffle grow with map tasks times reduce tasks. 100 TB make 32,768
    tasks of 3 GB, which spill but do not drown the cluster in blocks.
    """
    size = max(MIN_TASK_BYTES, -(-input_bytes // MAX_TASKS))
    return max(1, -(-input_bytes // size)), size


def size_for(spark: SparkSession, input_bytes: int, widened: int = 1) -> None:
    """Cut scans and shuffles for an input of this size, whose rows take ``widened`` times its bytes.

    Adaptive execution merges reduce partitions that turn out small but never
    adds any, so the first number has to fit the largest shuffle. A setting
    that is already higher stays.
    """
    tasks, size = task_layout(input_bytes * widened)
    _first_partitions(spark, tasks)
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size // widened))
    if widened > 1:
        _merged_up_to(spark, size)


def shuffles_for(spark: SparkSession, table_bytes: int) -> None:
    """Cut shuffles for joins of compact tables of this size; scans stay as they are.

    Their rows take up to WIDENED times the bytes of the files once keys are resolved to
    text. Too few partitions make every sort spill, and more so with each larger input.
    """
    tasks, size = task_layout(table_bytes * WIDENED)
    _first_partitions(spark, tasks)
    _merged_up_to(spark, size)


def _merged_up_to(spark: SparkSession, row_bytes: int) -> None:
    """Let adaptive execution merge shuffle blocks up to this many bytes as rows, which is what a sort holds.

    Blocks are compressed: merged up to a size of their own, they make the sorts spill.
    """
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(row_bytes // SHUFFLED_WIDENED))


def _first_partitions(spark: SparkSession, tasks: int) -> None:
    planned = int(spark.conf.get("spark.sql.shuffle.partitions"))
    initial = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    spark.conf.set(initial, str(max(planned, tasks)))


def together(spark: SparkSession, steps: dict[str, Callable[[], Any]]) -> dict[str, Any]:
    """Results of steps that don't need each other, by their names.

    Their jobs share the cores: the last tasks of one leave room for the first of the next,
    where steps in a row would wait for each other. All have ended when this returns or raises.
    """
    with ThreadPoolExecutor(AT_ONCE) as pool:
        running = {name: pool.submit(inheritable_thread_target(spark)(step)) for name, step in steps.items()}
    return {name: done.result() for name, done in running.items()}


def shared_dir(spark: SparkSession, *parts: str) -> str:
    """A folder all executors reach: below the one the cluster names.

    Only a local session without that setting gets a temporary folder; on a
    cluster the setting is required.
    """
    root = spark.conf.get(CHECKPOINT_SETTING, None)
    if not root:
        context = spark.sparkContext
        if not context.master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_SETTING} to a folder shared by all executors")
        if context.applicationId not in _local_roots:
            _local_roots[context.applicationId] = tempfile.mkdtemp(prefix="playlake-")
        root = _local_roots[context.applicationId]
    return "/".join([root.rstrip("/"), "playlake", *parts])


def fresh_dir(spark: SparkSession, name: str) -> str:
    """A new, not yet existing folder below :func:`shared_dir`."""
    return shared_dir(spark, f"{name}-{uuid.uuid4().hex}")
