"""Benchmark decontamination by a generalised suffix automaton of the test items.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after A-Z went to lower case. A window
is 13 consecutive words of an item, or a whole shorter item. A document streams
through the automaton, which tracks the longest match at each word.

Items are taken in blocks of at most about ``BLOCK_WORDS`` words, one automaton
each, so what is sent to the executors is bounded however many items there are;
a document's spans of several blocks are merged.

Defined cases: null or wordless texts have no hit; items without words have no
window; an item whose id is null or repeated counts once among ids (a null id:
not at all), its windows still hit; repeated documents are judged each on its
own; an empty benchmark leaves every document clean; other columns are not read
by :func:`judged` and pass unchanged through :func:`clean`.
"""

from __future__ import annotations

import re
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from playlake.llm.automaton import Windows
from playlake.llm.rows import map_batches, numbered, packed, small_batches, stored, texts, unpacked, with_columns

WIDTH = 13
BLOCK_WORDS = 200_000
COVERAGE = 20  # one hit word among this many words contaminates
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")

SPANS = "rid long, doc_id {kind}, n_words long, spans array<struct<a:int,b:int>>, items array<string>"
_SPAN_TYPE = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))


def words_of(text: bytes) -> list[bytes]:
    """Lower-cased words; bytes from 0x80 on belong to characters that are words."""
    return WORD.findall(text.lower())


def _sized(items: DataFrame) -> tuple[DataFrame, int]:
    """Distinct items with a block number each, and the number of blocks."""
    chosen = items.select(
        F.col("item_id").cast("string").alias("item_id"),
        F.coalesce("text", F.lit("")).alias("text"),
    ).distinct()
    words = chosen.agg(F.sum(F.length("text") / 2 + 1)).first()[0] or 0  # a word takes a gap
    count = 1 if words <= BLOCK_WORDS else int(2 * words // BLOCK_WORDS) + 1
    block = F.pmod(F.xxhash64(F.coalesce("item_id", F.lit("")), "text"), F.lit(count))
    return chosen.withColumn("block", block), count


def _block(sized: DataFrame, number: int) -> list[tuple[str | None, list[bytes]]]:
    """One block of items, of bounded size."""
    rows = sized.filter(F.col("block") == number).collect()
    return [(row.item_id, words_of(row.text.encode())) for row in rows]


def _searched(rows: DataFrame, block: list) -> DataFrame:
    """Spans and items of one block, for each document."""
    sent = rows.sparkSession.sparkContext.broadcast(block)

    def run(batches):
        windows = None
        for batch in batches:
            windows = windows or Windows(sent.value, WIDTH)
            counts, spans, items = [], [], []
            for text in texts(batch):
                words = words_of(text)
                found, keys = windows.hits(words)
                counts.append(len(words))
                spans.append([{"a": a, "b": b} for a, b in found])
                items.append(sorted(k for k in keys if k is not None))
            yield with_columns(
                batch,
                ["rid", "doc_id"],
                {
                    "n_words": pa.array(counts, pa.int64()),
                    "spans": pa.array(spans, _SPAN_TYPE),
                    "items": pa.array(items, pa.list_(pa.string())),
                },
            )

    return rows.mapInArrow(run, SPANS.format(kind=rows.schema["doc_id"].dataType.simpleString()))


def _merged(spans: list[dict]) -> list[dict]:
    """Spans of several blocks as spans that lie apart."""
    out: list[dict] = []
    for span in sorted(spans, key=lambda s: (s["a"], s["b"])):
        if out and span["a"] <= out[-1]["b"]:
            out[-1]["b"] = max(out[-1]["b"], span["b"])
        else:
            out.append(dict(span))
    return out


def _merge_batch(batch: pa.RecordBatch) -> pa.RecordBatch:
    spans = [_merged(x) for x in batch.column("spans").to_pylist()]
    return with_columns(
        batch,
        ["rid", "doc_id", "n_words"],
        {"spans": pa.array(spans, _SPAN_TYPE), "items": batch.column("items")},
    )


def matched(documents: DataFrame, items: DataFrame) -> DataFrame:
    """(rid, doc_id, n_words, spans, items): merged spans of hit words, sorted item ids."""
    small_batches(documents.sparkSession)
    rows = numbered(documents)
    sized, count = _sized(items)
    if count == 1:
        return _searched(rows, _block(sized, 0))
    # One block at a time: its result is stored before the next one is sent.
    parts = [stored(_searched(rows, _block(sized, k)), "decontamination") for k in range(count)]
    every = reduce(DataFrame.union, [parts[0], *(x.filter(F.size("spans") > 0) for x in parts[1:])])
    grouped = every.groupBy("rid").agg(
        F.max("doc_id").alias("doc_id"),
        F.max("n_words").alias("n_words"),
        F.flatten(F.collect_list("spans")).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
    )
    return map_batches(grouped, _merge_batch, SPANS.format(kind=rows.schema["doc_id"].dataType.simpleString()))


def _n_hit():
    return F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + (s["b"] - s["a"]))


def _contaminated(n_hit):
    return (n_hit > 0) & (COVERAGE * n_hit >= F.col("n_words"))


def judged(documents: DataFrame, items: DataFrame) -> DataFrame:
    """One row per document: hit words, items that occur, and the verdict."""
    found = matched(documents, items).select("doc_id", "n_words", _n_hit().alias("n_hit"), "items")
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256"),
        _contaminated(F.col("n_hit")).alias("contaminated"),
    )


def _without(text: bytes, spans: list[dict]) -> bytes:
    """The text without the hit words and what stands between them."""
    words, out, last = list(WORD.finditer(text.lower())), [], 0
    for span in spans:
        out.append(text[last : words[span["a"]].start()])
        last = words[span["b"] - 1].end()
    return b"".join([*out, text[last:]])


def _cut_batch(batch: pa.RecordBatch) -> pa.RecordBatch:
    spans = batch.column("spans").to_pylist()
    left = [t if t is None or not s else _without(t, s) for t, s in zip(texts(batch), spans, strict=True)]
    return with_columns(batch, ["row"], {"text": pa.array(left, pa.binary()).cast(pa.string())})


def clean(documents: DataFrame, items: DataFrame) -> DataFrame:
    """``documents`` without contaminated ones and without hit spans in the others.

    A document goes if hit words reach the coverage limit; else its spans (13
    words or longer, or whole short items) are cut out of ``text``, and
    ``n_chars``, if there, is counted again. Untouched texts stay as they are.
    """
    hit = matched(documents, items).filter(F.size("spans") > 0)
    hit = hit.select("rid", "spans", _contaminated(_n_hit()).alias("gone"))
    joined = packed(documents).join(hit, "rid", "left").filter(~F.coalesce("gone", F.lit(False)))
    rest = joined.select("row", F.col("row.text").alias("text"), "spans")
    cut = map_batches(rest, _cut_batch, f"row {rest.schema['row'].dataType.simpleString()}, text string")
    return unpacked(cut, documents)
