"""Tables replaced by a mark: readers see the old or the new version, whatever happens to the writer."""

import threading

import pytest
from pyspark.sql import functions as F

from playlake.operators import merge
from playlake.plans.serving import run_serving
from playlake.sources import files, versions
from tests.conftest import event, rows


def numbers(spark, n):
    return spark.range(n).withColumnRenamed("id", "n")


def test_a_version_replaces_the_one_before(spark, tmp_path):
    path = str(tmp_path / "view")
    assert versions.current(spark, path) is None and versions.versions(spark, path) == []
    assert versions.write_version(numbers(spark, 3), path) == 3
    before = versions.read_version(spark, path)
    assert versions.write_version(numbers(spark, 5), path, single_file=True) == 5
    assert versions.read_version(spark, path).count() == 5
    assert before.count() == 3  # a reader that had begun goes on
    assert files.read_view(spark, path).count() == 5


def test_a_killed_write_leaves_the_old_view(spark, tmp_path):
    path = str(tmp_path / "view")
    versions.write_version(numbers(spark, 3), path)
    broken = numbers(spark, 1000).repartition(8).select(
        F.when(F.col("n") == 700, F.raise_error(F.lit("lost"))).otherwise(F.col("n")).alias("n")
    )
    with pytest.raises(Exception, match="lost"):
        versions.write_version(broken, path)
    assert rows(files.read_view(spark, path)) == [(0,), (1,), (2,)]
    assert len(versions.versions(spark, path)) <= 2
    versions.write_version(numbers(spark, 4), path)
    assert files.read_view(spark, path).count() == 4


def test_a_stopped_job_leaves_the_old_view(spark, tmp_path):
    path = str(tmp_path / "view")
    versions.write_version(numbers(spark, 3), path)
    slow = numbers(spark, 8).repartition(8).select(F.expr("n + 0 * length(reflect('java.lang.Thread', 'sleep', 600000L))").alias("n"))
    failed = []

    def write():
        spark.sparkContext.addJobTag("to-be-stopped")
        try:
            versions.write_version(slow, path)
        except Exception as error:
            failed.append(error)

    from pyspark import InheritableThread

    writer = InheritableThread(target=write)
    writer.start()
    waited = threading.Event()
    for _ in range(60):
        waited.wait(0.5)
        if spark.sparkContext.statusTracker().getActiveStageIds():
            break
    spark.sparkContext.cancelJobsWithTag("to-be-stopped")
    writer.join(60)
    assert failed and files.read_view(spark, path).count() == 3


def test_restore_and_tidy(spark, tmp_path):
    path = str(tmp_path / "view")
    for n in range(1, 6):
        versions.write_version(numbers(spark, n), path)
    names = versions.versions(spark, path)
    versions.restore(spark, path, names[2])
    assert files.read_view(spark, path).count() == 3
    assert versions.tidy(spark, path, keep=1) == names[:1]
    assert versions.versions(spark, path) == names[1:]
    with pytest.raises(ValueError):
        versions.restore(spark, path, names[0])
    assert versions.tidy(spark, str(tmp_path / "none")) == []


def test_plain_reads_find_no_mix_of_versions(spark, tmp_path):
    path = str(tmp_path / "view")
    for n in (1, 2):
        versions.write_version(numbers(spark, n), path)
    with pytest.raises(Exception, match="UNABLE_TO_INFER_SCHEMA"):
        spark.read.parquet(path)


def test_serving_twice_swaps_every_view(spark, plays, tmp_path):
    base = str(tmp_path)
    from playlake.plans.batch import run_batch

    files.write_parquet(plays(event(), event(userId=2)), f"{base}/raw/run=a/batch_id=0")
    run_batch(spark, f"{base}/raw", f"{base}/store", models=False)
    run_serving(spark, f"{base}/store", f"{base}/none", f"{base}/export")
    held = files.read_view(spark, f"{base}/export/merged_active_ts")
    files.write_parquet(plays(event(userId=3)), f"{base}/speed/run=a/batch_id=1")
    run_serving(spark, f"{base}/store", f"{base}/speed", f"{base}/export")
    assert held.count() == 1
    assert files.read_view(spark, f"{base}/export/merged_top_songs").first()["merged_plays"] == 3
    summary = files.read_view(spark, f"{base}/export/speed_summary").first()
    assert (summary["batch_total"], summary["stream_total"]) == (2, 1)
    assert merge.speed_level(plays(event())).count() == 1
