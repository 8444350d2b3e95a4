"""Target-distribution importance resampling of documents.

Words (runs of ``WORD`` bytes after A-Z went to lower case) are counted by buckets of
their crc32, over all documents and over all texts of the target. A bucket's gain is
the scaled log ratio of both shares; a document's weight is the sum of the gains of
its words, read from one array of ``BUCKETS`` numbers that every task gets. Adding
noise of a Gumbel distribution, a function of the document's id, makes the highest
scores a weighted draw without replacement.

The cutoff of the draw is found without sorting all scores: a quantile sketch gives a
bracket around it, the rows above and in the bracket are counted exactly, and the
bracket is widened until it holds the cutoff. Only the bracket's rows are put in order, dealt
to tasks by ranges. The drawn rows are then ranked the same way (``functions.ranks``).

Defined cases: a null text is empty and has no word; a null id counts as an empty
one in the noise and comes last among ties; documents of equal scores are taken by
smaller id, then by fewer features, then by place in the table, so repeated rows take one rank
each; nothing is drawn from an empty table, or where the share of the eligible
documents is below one; an empty target gives the gains of its empty shares; words of
any length count; other columns are not read.
"""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from playlake.functions import ranks
from playlake.llm.rows import numbered, small_batches, stored, texts, with_columns

BUCKETS = 10_000
SEED = 2024
LEAST_WORDS = 20
PERCENT = 10
WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SKETCH = 800  # size of the sketch: ranks are off by about 0.4 %
MARGIN = 0.01  # of all ranks, on both sides of the cutoff at first
KEPT_WORDS = 500_000


class Buckets:
    """The buckets of words, each distinct one worked out once for a while."""

    def __init__(self):
        self.known: dict[bytes, int] = {}

    def counts(self, text: bytes) -> tuple[np.ndarray, np.ndarray, int]:
        """(buckets, their counts, number of words) of a text; a bucket may come several times."""
        words = WORD.findall(text.lower())
        found = Counter(words)
        known = self.known
        if len(known) >= KEPT_WORDS:
            known.clear()
        for word in found:
            if word not in known:
                known[word] = zlib.crc32(word) % BUCKETS
        buckets = np.fromiter(map(known.__getitem__, found), np.int64, len(found))
        return buckets, np.fromiter(found.values(), np.int64, len(found)), len(words)


def bucket_counts(rows: DataFrame) -> np.ndarray:
    """Words per bucket over all rows' ``text``; at most BUCKETS rows come to the driver."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, total = Buckets(), np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for text in texts(batch):
                buckets, times, _ = held.counts(text)
                np.add.at(total, buckets, times)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["bucket", "n"])

    parts = rows.select("text").mapInArrow(count, "bucket long, n long")
    found = np.zeros(BUCKETS, np.int64)
    for row in parts.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        found[row["bucket"]] = row["n"]
    return found


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln(ratio of the target's smoothed share to the source's)) of each bucket."""
    every, wanted = int(source.sum()), int(target.sum())
    ratios = (
        float((int(t) + 1) * (every + BUCKETS)) / float((int(s) + 1) * (wanted + BUCKETS))
        for s, t in zip(source, target, strict=True)
    )
    return np.array([math.floor(1000 * math.log(ratio)) for ratio in ratios], np.int64)


def noise(doc_id, seed: int) -> int:
    """Scaled Gumbel noise that depends on the id alone."""
    name = f"{seed}:{'' if doc_id is None else doc_id}"
    value = int(hashlib.sha256(name.encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((value + 0.5) / 4294967296)))


def weighed(rows: DataFrame, gain: np.ndarray, seed: int = SEED) -> DataFrame:
    """(rid, doc_id, n_features, weight, score) of numbered rows."""
    table = rows.sparkSession.sparkContext.broadcast(gain)
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, gained = Buckets(), table.value
        for batch in batches:
            counts, weights, scores = [], [], []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts(batch), strict=True):
                buckets, times, size = held.counts(text)
                weight = int(gained[buckets] @ times)
                counts.append(size)
                weights.append(weight)
                scores.append(weight + noise(doc_id, seed))
            columns = {"n_features": counts, "weight": weights, "score": scores}
            yield with_columns(batch, ["rid", "doc_id"], {c: pa.array(v, pa.int64()) for c, v in columns.items()})

    return rows.mapInArrow(run, f"rid long, doc_id {kind}, n_features long, weight long, score long")


def _store(name: str):
    return lambda frame: stored(frame, name)


def _order() -> list[Column]:
    return [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("n_features"), F.asc("rid")]


def cutoff(eligible: DataFrame, count: int, total: int) -> dict:
    """The row (score, doc_id, n_features, rid) that is number ``count`` of ``total`` from the top.

    ``eligible`` is a stored table; 1 <= count <= total. A bracket of one score that many
    rows share is as good as any: its rows are told apart by the rest of the order.
    """
    sketch = eligible.agg(F.kll_sketch_agg_bigint("score", F.lit(SKETCH)).alias("sketch")).first()["sketch"]
    spark = eligible.sparkSession
    margin, at = MARGIN, 1 - (count - 0.5) / total
    while True:
        ends = [max(0.0, at - margin), min(1.0, at + margin)]
        held = spark.createDataFrame([(sketch,)], "sketch binary")
        low, high = held.select(
            *[F.kll_sketch_get_quantile_bigint("sketch", F.lit(q)).alias(f"q{n}") for n, q in enumerate(ends)]
        ).first()
        low = None if ends[0] == 0 else low  # an open end takes all rows on its side
        high = None if ends[1] == 1 else high
        above = F.lit(False) if high is None else F.col("score") > high
        inside = ~above & (F.lit(True) if low is None else F.col("score") >= low)
        counts = eligible.agg(F.count_if(above).alias("above"), F.count_if(inside).alias("inside")).first()
        if counts["above"] < count <= counts["above"] + counts["inside"]:
            break
        margin *= 2
    wanted = count - counts["above"]  # the cutoff's number within the bracket
    bracket = eligible.filter(inside).select("score", "doc_id", "n_features", "rid")
    rows, sizes = ranks.placed(bracket, _order(), _store("importance-bracket"))
    before = ranks.starts(sizes)
    task = max(t for t, rows_before in before.items() if rows_before < wanted)
    place = wanted - 1 - before[task]
    return rows.filter((F.col("task") == task) & (F.col("place") == place)).first().asDict()


def _drawn(edge: dict) -> Column:
    """Whether a row is at the cutoff or before it, in order."""
    column = F.col("doc_id")
    same = column.eqNullSafe(F.lit(edge["doc_id"]))
    earlier = F.lit(True) if edge["doc_id"] is None else F.coalesce(column < F.lit(edge["doc_id"]), F.lit(False))
    if edge["doc_id"] is None:
        earlier = column.isNotNull()
    fewer = F.col("n_features") < edge["n_features"]
    tied = fewer | ((F.col("n_features") == edge["n_features"]) & (F.col("rid") <= edge["rid"]))
    return (F.col("score") > edge["score"]) | ((F.col("score") == edge["score"]) & (earlier | (same & tied)))


def resampled(
    documents: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS, seed: int = SEED
) -> DataFrame:
    """(doc_id, n_features, weight, score, rank) of every document; rank is null for those not drawn."""
    small_batches(documents.sparkSession)
    rows = numbered(documents)
    wanted = target.select(F.coalesce("text", F.lit("")).alias("text"))
    gain = gains(bucket_counts(rows), bucket_counts(wanted))
    scored = stored(weighed(rows, gain, seed), "importance-scores")
    fit = F.col("n_features") >= least_words
    total = scored.filter(fit).count()
    count = percent * total // 100
    columns = ["doc_id", "n_features", "weight", "score"]
    if not count:
        return scored.select(*columns, F.lit(None).cast("long").alias("rank"))
    chosen = fit & _drawn(cutoff(scored.filter(fit), count, total))
    drawn = ranks.ranked(scored.filter(chosen), _order(), _store("importance-drawn"))
    rest = scored.filter(~chosen).select(*columns, F.lit(None).cast("long").alias("rank"))
    return drawn.select(*columns, "rank").unionByName(rest)
