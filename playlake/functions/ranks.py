"""Places of rows in an order over the whole table, without one task that sees them all."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window, functions as F

PLACE = 33  # bits of a row's place within its task


def placed(
    frame: DataFrame, order: list[Column], store: Callable[[DataFrame], DataFrame], tasks: int | None = None
) -> tuple[DataFrame, DataFrame]:
    """(rows with ``task`` and ``place``, rows per task), both in ``order``.

    Rows are dealt by ranges of the order and sorted within tasks, so a row's rank is
    its place plus the rows of the tasks before. ``order`` should leave no ties, or
    equal rows come together in one task. ``store`` writes a frame and reads it back:
    places are those of one run of the tasks and must not be worked out anew.
    """
    tasks = tasks or int(frame.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = frame.repartitionByRange(tasks, *order).sortWithinPartitions(*order)
    number = F.monotonically_increasing_id()
    held = store(
        ranged.withColumn("_n", number).select(
            *[F.col(f"`{c}`") for c in frame.columns],
            F.shiftright("_n", PLACE).cast("int").alias("task"),
            F.col("_n").bitwiseAND(F.lit((1 << PLACE) - 1)).alias("place"),
        )
    )
    return held, held.groupBy("task").agg(F.count(F.lit(1)).alias("rows"))


def starts(counts: DataFrame, value: str = "rows") -> dict[int, int]:
    """task -> sum of ``value`` over the tasks before it; ``counts`` has one row per task."""
    total, before = 0, {}
    for row in counts.select("task", value).orderBy("task").collect():
        before[row["task"]] = total
        total += row[value]
    return before


def by_task(frame: DataFrame, values: dict[int, int], name: str) -> DataFrame:
    """``frame`` with a value of its task (one row per task is sent, whatever the rows)."""
    spark = frame.sparkSession
    table = spark.createDataFrame(list(values.items()), f"task int, {name} long")
    return frame.join(F.broadcast(table), "task")


def ranked(
    frame: DataFrame, order: list[Column], store: Callable[[DataFrame], DataFrame], name: str = "rank"
) -> DataFrame:
    """``frame`` with each row's rank (1, 2, 3, ...) in ``order``."""
    held, counts = placed(frame, order, store)
    rows = by_task(held, starts(counts), "_before")
    rank = (F.col("_before") + F.col("place") + 1).alias(name)
    return rows.select(*[F.col(f"`{c}`") for c in frame.columns], rank)


def roc_auc(
    frame: DataFrame, score: str, label: str, keys: list[str], store: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """(keys, positives, negatives, auc): area under ROC per key, as average ranks give it.

    A positive counts each negative of a lower score once and each of its own score half.
    Rows shrink to counts per score first, so a score that many rows share is one row; the
    scores are dealt to tasks by ranges, and a task adds the negatives of the tasks before to
    its own running sum. All counts are exact. ``auc`` is null without both labels; rows without
    score or label don't count.
    """
    known = frame.filter(F.col(score).isNotNull() & F.col(label).isNotNull())
    one, none = F.count_if(F.col(label) == 1), F.count_if(F.col(label) != 1)
    counts = known.groupBy(*keys, F.col(score).alias("_score")).agg(one.alias("_pos"), none.alias("_neg"))
    held, _ = placed(counts, [*map(F.col, keys), F.col("_score")], store)
    names = [*keys, "task"]
    totals = held.groupBy(*names).agg(F.sum("_neg").alias("_all"))
    earlier = Window.partitionBy(*keys).orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    before = totals.select(
        *[F.col(c).alias(f"_{c}") for c in names], F.coalesce(F.sum("_all").over(earlier), F.lit(0)).alias("_before")
    )
    rows = held.join(before, reduce(and_, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in names]))
    lower = Window.partitionBy(*names).orderBy("_score").rowsBetween(Window.unboundedPreceding, -1)
    below = F.col("_before") + F.coalesce(F.sum("_neg").over(lower), F.lit(0))
    twice = F.col("_pos").cast("decimal(18,0)") * (2 * below + F.col("_neg")).cast("decimal(19,0)")
    ranked_ = rows.withColumn("_twice", twice)
    found = ranked_.groupBy(*keys).agg(
        F.sum("_pos").alias("positives"), F.sum("_neg").alias("negatives"), F.sum("_twice").alias("_twice")
    )
    both = F.col("positives").cast("double") * F.col("negatives") * 2
    return found.select(*keys, "positives", "negatives", F.try_divide(F.col("_twice").cast("double"), both).alias("auc"))
