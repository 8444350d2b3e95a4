"""Corpus-wide values of terms, brought to the documents that hold them.

A term's value (a count, a probability, a number of pieces) is worked out once.
Terms frequent enough to weigh in the shuffle are sent to all tasks as a table of
at most ``FREQUENT`` rows; the others go through a join. So no hot term is
shuffled, and what is sent does not grow with the corpus.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

FREQUENT = 131_072
LONGEST = 64  # bytes of a term that may be sent


def frequent_from(counts: DataFrame) -> int:
    """The least count ``n`` (a power of two) that at most FREQUENT terms reach."""
    by_size = counts.groupBy(F.floor(F.log2("n")).alias("size")).agg(F.count(F.lit(1)).alias("terms"))
    total = 0
    for row in sorted(by_size.collect(), key=lambda row: -row["size"]):  # at most 64 rows
        total += row["terms"]
        if total > FREQUENT:
            return 2 ** (row["size"] + 1)
    return 1


def is_frequent(least: int):
    return (F.col("n") >= least) & (F.octet_length("term") <= LONGEST)
