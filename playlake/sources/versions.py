"""Tables that are replaced at once: every write is a folder of its own, and a mark names the one to read.

``path`` holds ``_v-<time>-<id>`` folders and the file ``_CURRENT``. A write fills a new
folder and then swaps the mark, in one rename. A job that is lost before that leaves a
folder nobody reads, and readers keep the version they had; a query that is already
reading goes on with its files. Spark hides names that begin with ``_``, so a reader
that does not resolve the mark finds nothing rather than a mix of versions.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

MARK = "_CURRENT"
FOLDER = "_v-"


def _files(spark: SparkSession, path: str):
    """(Hadoop's file system of a path, a maker of its paths)."""
    jvm = spark.sparkContext._jvm
    make = lambda name: jvm.org.apache.hadoop.fs.Path(name)
    return make(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), make


def exists(spark: SparkSession, path: str) -> bool:
    files, make = _files(spark, path)
    return files.exists(make(path))


def size(spark: SparkSession, path: str) -> int:
    """Bytes of the files of a folder; 0 without one."""
    files, make = _files(spark, path)
    return files.getContentSummary(make(path)).getLength() if files.exists(make(path)) else 0


def move(spark: SparkSession, source: str, target: str) -> None:
    """Move a file or folder to a path that isn't there yet."""
    files, make = _files(spark, target)
    files.mkdirs(make(target).getParent())
    if files.exists(make(target)) or not files.rename(make(source), make(target)):
        raise OSError(f"can't move {source} to {target}")


def replace_folders(spark: SparkSession, source: str, target: str) -> None:
    """Each folder directly below ``source`` takes the place of the one of its name below ``target``.

    Files are moved; those that were there before are removed once the new ones are in place.
    """
    files, make = _files(spark, target)
    for folder in files.listStatus(make(source)):
        if not folder.isDirectory():
            continue
        name = folder.getPath().getName()
        place = f"{target}/{name}"
        old = [f.getPath() for f in files.listStatus(make(place))] if files.exists(make(place)) else []
        for fresh in files.listStatus(folder.getPath()):
            move(spark, fresh.getPath().toString(), f"{place}/{fresh.getPath().getName()}")
        for path in old:
            files.delete(path, True)


def _swap(spark: SparkSession, path: str, version: str) -> None:
    """Let the mark of ``path`` name a version, in one step."""
    files, make = _files(spark, path)
    fresh = make(f"{path}/{MARK}.{uuid.uuid4().hex}")
    out = files.create(fresh, True)
    out.write(bytearray(version.encode()))
    out.close()
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(files.getUri(), conf)
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context.rename(files.makeQualified(fresh), files.makeQualified(make(f"{path}/{MARK}")), options)


def current(spark: SparkSession, path: str) -> str | None:
    """The folder to read, or None where ``path`` has no mark."""
    files, make = _files(spark, path)
    mark = make(f"{path}/{MARK}")
    if not files.exists(mark):
        return None
    held = files.open(mark)
    name = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(held, "UTF-8")
    held.close()
    return f"{path}/{name}"


def versions(spark: SparkSession, path: str) -> list[str]:
    """Names of all version folders, oldest first."""
    files, make = _files(spark, path)
    if not files.exists(make(path)):
        return []
    names = [status.getPath().getName() for status in files.listStatus(make(path)) if status.isDirectory()]
    return sorted(name for name in names if name.startswith(FOLDER))


def write_version(df: DataFrame, path: str, single_file: bool = False) -> int:
    """Write ``df`` as the new version of ``path``; returns the rows written."""
    spark = df.sparkSession
    counted = Observation()
    out = df.observe(counted, F.count(F.lit(1)).alias("rows"))
    if single_file:
        out = out.coalesce(1)
    name = f"{FOLDER}{time.time_ns():020d}-{uuid.uuid4().hex}"
    out.write.parquet(f"{path}/{name}")
    _swap(spark, path, name)
    return counted.get["rows"]


def read_version(spark: SparkSession, path: str) -> DataFrame:
    """The current version of a table; a plain Parquet folder is read as it is."""
    return spark.read.parquet(current(spark, path) or path)


def restore(spark: SparkSession, path: str, name: str) -> None:
    """Go back (or forth) to a version that is still there."""
    if name not in versions(spark, path):
        raise ValueError(f"no version {name} below {path}")
    _swap(spark, path, name)


def tidy(spark: SparkSession, path: str, keep: int = 2) -> list[str]:
    """Remove all but the current version and the ``keep`` newest before it; names of those removed.

    Folders newer than the current one may still be being written and stay.
    """
    files, make = _files(spark, path)
    held = current(spark, path)
    if held is None:
        return []
    older = [name for name in versions(spark, path) if name < held.rsplit("/", 1)[1]]
    gone = older[: max(0, len(older) - keep)]
    for name in gone:
        files.delete(make(f"{path}/{name}"), True)
    return gone
