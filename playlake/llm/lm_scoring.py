"""LM scoring: the marginal probability of a text over all subword segmentations.

The pieces are those of an existing vocabulary. Its file holds merge ranks, not
probabilities, so a piece's score is its smoothed share among the pieces of the
training documents' words; the vocabulary itself is never changed. A word's
probability sums over every way to write it in pieces (forward recursion in log
space; characters outside the vocabulary go by byte pieces). Pieces don't cross
words, so a text's log probability is the sum over its words and one end.

Each distinct word is scored once; see ``terms`` for how values reach documents.

Defined cases: a null text is empty and has one token, the end; without training
documents all counts are 0 and the base probability of a token is 1 (one unseen
type, V = 0); repeated rows score alike, each in a row of its own; an empty table
gives an empty result; other columns are not read.
"""

from __future__ import annotations

import math
from collections import Counter
from itertools import repeat

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, functions as F

from playlake.llm.rows import LOWER, SPACES, UPPER, map_batches, numbered, remainder, small_batches, stored, texts
from playlake.llm.terms import frequent_from, is_frequent

FOLDS = 10
ADD = 0.1
END = "</s>"
SPACE = "▁"


def word_counts(documents: DataFrame) -> DataFrame:
    """(term, c, n): each word's count in training documents and in all of them."""
    plain = F.translate(
        F.coalesce("text", F.lit("")), UPPER + SPACES, LOWER + " " * len(SPACES)
    )
    words = documents.select(
        (remainder("doc_id", FOLDS) != 0).cast("long").alias("train"),
        F.explode(F.split(plain, " ")).alias("term"),
    ).filter(F.col("term") != "")
    return words.groupBy("term").agg(F.sum("train").alias("c"), F.count(F.lit(1)).alias("n"))


class Lattice:
    """Scores of pieces, and the log10 probability of a word over all its segmentations."""

    def __init__(self, pieces: dict[str, float], byte_scores: list[float]):
        self.pieces = pieces
        self.bytes = byte_scores
        self.prefixes = {piece[:k] for piece in pieces for k in range(1, len(piece) + 1)}

    def word(self, word: str) -> float:
        text = SPACE + word
        size = len(text)
        alpha: list[float | None] = [None] * (size + 1)
        alpha[0] = 0.0
        pieces, prefixes = self.pieces, self.prefixes
        for start in range(size):
            base = alpha[start]
            if base is None:
                continue
            edges = [(start + 1, sum(self.bytes[b] for b in text[start].encode()))]
            end = start + 1
            while end <= size and (piece := text[start:end]) in prefixes:
                score = pieces.get(piece)
                if score is not None:
                    edges.append((end, score))
                end += 1
            for end, score in edges:
                new, old = base + score, alpha[end]
                if old is None:
                    alpha[end] = new
                elif old > new:
                    alpha[end] = old + math.log1p(math.exp(new - old))
                else:
                    alpha[end] = new + math.log1p(math.exp(old - new))
        return alpha[size] / math.log(10)


def _piece_counts(counts: DataFrame, model: str) -> DataFrame:
    """(piece, n): pieces of the training words, each word cut once and weighted by its count."""

    def cut(batches):
        processor = sentencepiece.SentencePieceProcessor(model_file=model)
        size = processor.get_piece_size()
        total = np.zeros(size, np.int64)
        for batch in batches:
            found = processor.encode(batch.column("term").to_pylist(), num_threads=1)
            for ids, count in zip(found, batch.column("c").to_pylist(), strict=True):
                np.add.at(total, ids, count)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["piece", "n"])

    seen = counts.filter("c > 0").select("term", "c").mapInArrow(cut, "piece long, n long")
    return seen.groupBy("piece").agg(F.sum("n").alias("n"))


def fit(counts: DataFrame, ends: int, model: str) -> tuple[Lattice, float]:
    """The lattice and the log10 probability of the end; one row per piece comes to the driver."""
    processor = sentencepiece.SentencePieceProcessor(model_file=model)
    size = processor.get_piece_size()
    seen = {row.piece: row.n for row in _piece_counts(counts, model).collect()}
    # Sums of a 64-bit count each: the vocabulary bounds their number.
    whole = sum(seen.values()) + ends + size
    pieces, byte_scores = {}, [0.0] * 256
    for piece in range(size):
        if processor.is_control(piece) or processor.is_unknown(piece):
            continue
        text, score = processor.id_to_piece(piece), math.log((seen.get(piece, 0) + 1) / whole)
        if processor.is_byte(piece):
            byte_scores[int(text[3:5], 16)] = score
        else:
            pieces[text] = score
    return Lattice(pieces, byte_scores), math.log10((ends + 1) / whole)


def scored(documents: DataFrame, model: str) -> DataFrame:
    """One row per document: its tokens, the base score and the model's score."""
    spark = documents.sparkSession
    small_batches(spark)
    counts = stored(word_counts(documents), "lm-words")
    sums = counts.agg(F.sum("c").alias("c"), F.sum((F.col("c") > 0).cast("long")).alias("v")).first()
    ends = documents.filter(remainder("doc_id", FOLDS) != 0).count()
    tokens, types = (sums.c or 0) + ends, (sums.v or 0) + (ends > 0)
    whole = tokens + ADD * (types + 1)
    lattice, end_score = fit(counts, ends, model)
    end_base, end_known = math.log10((ends + ADD) / whole), int(ends > 0)
    sent = spark.sparkContext.broadcast(lattice)

    def values(batch: pa.RecordBatch) -> pa.RecordBatch:
        known = np.array(batch.column("c").to_pylist(), np.float64)
        marginal = [sent.value.word(word) for word in batch.column("term").to_pylist()]
        return pa.RecordBatch.from_arrays(
            [
                batch.column("term"),
                pa.array((known > 0).astype(np.int64)),
                pa.array(np.log10((known + ADD) / whole)),
                pa.array(marginal, pa.float64()),
            ],
            ["term", "known", "base", "marginal"],
        )

    schema = "term string, known long, base double, marginal double"
    least = frequent_from(counts)
    top = map_batches(counts.filter(is_frequent(least)).select("term", "c"), values, schema).collect()
    table = spark.sparkContext.broadcast({r.term.encode(): (r.known, r.base, r.marginal) for r in top})
    rare = map_batches(counts.filter(~is_frequent(least)).select("term", "c"), values, schema)

    rows = numbered(documents)
    kind = rows.schema["doc_id"].dataType.simpleString()
    head = pa.struct([("tokens", pa.int64()), ("known", pa.int64()), ("base", pa.float64()), ("marginal", pa.float64())])

    def pairs(batches):
        get = table.value.get
        for batch in batches:
            ids, terms, times, heads, places = [], [], [], [], []
            rids = batch.column("rid").to_pylist()
            for place, text in enumerate(texts(batch)):
                words = text.lower().split()
                known, base, marginal = end_known, end_base, end_score
                for word, count in Counter(words).items():
                    value = get(word)
                    if value is None:
                        places.append(place)
                        terms.append(word)
                        times.append(count)
                    else:
                        known += count * value[0]
                        base += count * value[1]
                        marginal += count * value[2]
                ids.append(place)
                heads.append({"tokens": len(words) + 1, "known": known, "base": base, "marginal": marginal})
            order = pa.array(ids + places, pa.int32())
            # A document's own row has a key that no word has: a space and its number.
            own = [b" %d" % rid for rid in rids]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("rid").take(order),
                    pa.concat_arrays([batch.column("doc_id"), pa.nulls(len(places), batch.column("doc_id").type)]),
                    pa.array(own + terms, pa.binary()).cast(pa.string()),
                    pa.array([0] * len(ids) + times, pa.int64()),
                    pa.array(heads + list(repeat(None, len(places))), head),
                ],
                ["rid", "doc_id", "term", "times", "head"],
            )

    counted = rows.mapInArrow(
        pairs,
        f"rid long, doc_id {kind}, term string, times long, "
        "head struct<tokens:long,known:long,base:double,marginal:double>",
    )
    joined = counted.join(rare, "term", "left")
    total = lambda own, each: F.sum(
        F.coalesce(F.col(f"head.{own}"), F.col("times") * F.col(each), F.lit(0))
    ).alias(own)
    summed = joined.groupBy("rid").agg(
        F.max("doc_id").alias("doc_id"),
        F.sum("head.tokens").alias("n_tokens"),
        total("known", "known").alias("n_known"),
        total("base", "base").alias("base_score"),
        total("marginal", "marginal").alias("score"),
    )
    return summed.select(
        "doc_id",
        (remainder("doc_id", FOLDS) == 0).alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(tokens).cast("long").alias("train_tokens"),
        "base_score",
        "score",
    )
