"""Near-duplicates by BagMinHash over five-word shingle multisets.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after A-Z went to lower case; a text of
one to four words has one shingle, all its words. A text is the multiset of its
shingles, and similarity is weighted Jaccard.

*Signature.* The weight axis of a shingle is cut at 0, 1, 2, 4, 8, ... Each stretch
has a Poisson process whose rate is its length; a point has a time, a place on
the axis and one of the signature's components. A component keeps the earliest
point that lies below the shingle's weight. Times come in rising order, so a
process ends as soon as it is later than the text's latest component. Two texts
agree in a component with the probability of their similarity.

*Bands, links, classes.* Texts of equal multisets collapse first. Texts that agree
in a band are candidates: each is verified against the first text of its bucket
and then, where classes are still apart, against the last. In buckets of several
classes that are left, texts of different classes are compared by coarse counts
(shingles per ``CELLS`` hash values), which bound the overlap from above: a pair
below the bound cannot be a link, so none is left out, and only the others are
made rows, each in the first band that its texts share. A text's likely partners are
verified in turns, a few first, then all others; classes meet after each turn,
and pairs within a class need no row any more. Such buckets are taken in blocks of ``BLOCK`` texts, so a bucket of any
size is spread over tasks. A link needs an exact overlap of ``SIMILAR``; classes
are connected components of links.

Defined cases: a null text is empty; texts without words are copies if they are
equal, and similar to no other text; repeated rows are copies, each in a row of its
own; the first row of a class in the table's order is kept; an empty table gives an
empty result; other columns are not read by :func:`classes` and pass unchanged
through :func:`keep_first`.
"""

from __future__ import annotations

import hashlib
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from playlake.llm.rows import map_batches, numbered, packed, small_batches, stored, texts, with_columns

SHINGLE = 5
SIMILAR = 0.8
BANDS, BAND_ROWS = 24, 4
SIZE = BANDS * BAND_ROWS
LONG_WORD = 64
CELLS = 256
MOST = 65535  # of a cell's count
BLOCK = 1024
TURNS = (16,)  # likely partners of a text before its classes are looked at again
MASK = 2**64 - 1

_WORD = np.zeros(256, bool)
_WORD[list(b"0123456789abcdefghijklmnopqrstuvwxyz")] = True
_WORD[128:] = True


def _mixed(x: np.ndarray) -> np.ndarray:
    """A scrambling of 64-bit values, one to one."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_values(found: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit values of the words of all texts, the text of each word)."""
    data = np.frombuffer(b" ".join([*found, b""]).lower(), np.uint8)
    edges = np.diff(np.concatenate([[False], _WORD[data], [False]]).astype(np.int8))
    starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    sizes = ends - starts
    values = sizes.astype(np.uint64)
    active = np.arange(len(starts))
    for place in range(min(LONG_WORD, int(sizes.max(initial=0)))):
        active = active[sizes[active] > place]
        values[active] = (values[active] ^ data[starts[active] + place]) * np.uint64(0x100000001B3)
        values[active] ^= values[active] >> np.uint64(29)
    for word in np.flatnonzero(sizes > LONG_WORD).tolist():
        digest = hashlib.blake2b(data[starts[word] : ends[word]].tobytes(), digest_size=8).digest()
        values[word] = np.frombuffer(digest, np.uint64)[0]
    lengths = np.array([len(t) + 1 for t in found], np.int64)
    owner = np.searchsorted(np.cumsum(lengths), starts, side="right")
    return _mixed(values), owner


def shingles(found: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, value, weight) of every distinct shingle, ordered by text and value."""
    values, owner = word_values(found)
    counts = np.bincount(owner, minlength=len(found))
    starts = np.concatenate([[0], np.cumsum(counts)[:-1]])
    total = np.zeros(len(values), np.uint64)
    inside = np.arange(len(values)) - starts[owner]
    for step in range(SHINGLE):
        there = inside + step < counts[owner]
        nxt = np.where(there, np.roll(values, -step), np.uint64(0))
        total = total * np.uint64(0x9E3779B97F4A7C15) + nxt
        total ^= total >> np.uint64(32)
    first = (inside + SHINGLE <= counts[owner]) | ((inside == 0) & (counts[owner] < SHINGLE))
    value, text = _mixed(total[first]), owner[first]
    order = np.lexsort((value, text))
    value, text = value[order], text[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (text[1:] != text[:-1])
    at = np.flatnonzero(new)
    return text[at], value[at], np.diff(np.append(at, len(value)))


def _uniform(seed: np.ndarray) -> np.ndarray:
    return ((seed >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53


def signatures(count: int, text: np.ndarray, value: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """BagMinHash components of ``count`` texts; rows of texts without shingles are infinite."""
    least = np.full(count * SIZE, np.inf)
    # One process for each stretch (0, 1], (1, 2], (2, 4], ... that begins below a weight.
    parts, low, high = [], 0, 1
    below = np.arange(len(value))
    while len(below):
        parts.append((below, np.full(len(below), low), np.full(len(below), high)))
        low, high = high, high * 2
        below = below[weight[below] > low]
    if not parts:
        return least.reshape(count, SIZE)
    which = np.concatenate([p[0] for p in parts])
    low = np.concatenate([p[1] for p in parts]).astype(np.float64)
    rate = np.concatenate([p[2] for p in parts]) - low
    seed = _mixed(value[which] + low.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    row, top, time = text[which], weight[which], np.zeros(len(which))
    turn = 0
    while len(seed):
        turn += 1
        here = _mixed(seed + np.uint64(turn * 0xD1342543DE82EF95 & MASK))
        time = time - np.log(_uniform(here)) / rate
        other = _mixed(here + np.uint64(0x632BE59BD9B4E019))
        component = (other % np.uint64(SIZE)).astype(np.int64)
        inside = low + _uniform(_mixed(other)) * rate <= top
        np.minimum.at(least, row[inside] * SIZE + component[inside], time[inside])
        going = time < least.reshape(count, SIZE).max(axis=1)[row]
        seed, row, top, time, low, rate = (x[going] for x in (seed, row, top, time, low, rate))
    return least.reshape(count, SIZE)


def bands(signature: np.ndarray) -> np.ndarray:
    """One 64-bit key per band and text."""
    bits = np.ascontiguousarray(signature).view(np.uint64).reshape(-1, BANDS, BAND_ROWS)
    keys = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), bits.shape[:2]).copy()
    for part in range(BAND_ROWS):
        keys = _mixed(keys * np.uint64(0x9E3779B97F4A7C15) + bits[:, :, part])
    return keys.view(np.int64)


def _counted_once(text: np.ndarray, value: np.ndarray, weight: np.ndarray, count: int) -> list[bytes]:
    """Each text's multiset as sorted 64-bit values, a shingle's n-th copy being a value of its own."""
    copies = np.arange(weight.sum()) - np.repeat(np.cumsum(weight) - weight, weight)
    every = _mixed(np.repeat(value, weight) + copies.astype(np.uint64) * np.uint64(0xA0761D6478BD642F))
    owner = np.repeat(text, weight)
    order = np.lexsort((every, owner))
    every, ends = every[order], np.cumsum(np.bincount(owner, minlength=count))
    return [every[a:b].tobytes() for a, b in zip(np.concatenate([[0], ends[:-1]]), ends, strict=True)]


def _sketch(batch: pa.RecordBatch) -> pa.RecordBatch:
    found = texts(batch)
    text, value, weight = shingles(found)
    keys = bands(signatures(len(found), text, value, weight))
    ends = np.cumsum(np.bincount(text, minlength=len(found)))
    digests, listed = [], []
    for number, (a, b) in enumerate(zip(np.concatenate([[0], ends[:-1]]), ends, strict=True)):
        if a == b:
            digests.append(hashlib.blake2b(b"text" + found[number], digest_size=16).digest())
            listed.append([])
        else:
            content = value[a:b].tobytes() + weight[a:b].tobytes()
            digests.append(hashlib.blake2b(content, digest_size=16).digest())
            listed.append(keys[number])
    return with_columns(
        batch,
        ["rid", "doc_id"],
        {"digest": pa.array(digests, pa.binary()), "bands": pa.array(listed, pa.list_(pa.int64()))},
    )


def _cells(text: np.ndarray, value: np.ndarray, weight: np.ndarray, count: int) -> list[bytes]:
    """Each text's shingles per cell of their values, as 16-bit counts.

    A text with more in a cell than that gets the largest count in all cells; two such
    texts are bounded by their sizes alone.
    """
    cell = text * CELLS + (value % np.uint64(CELLS)).astype(np.int64)
    counts = np.bincount(cell, weight, minlength=count * CELLS).reshape(count, CELLS)
    counts[(counts > MOST).any(axis=1)] = MOST
    return [row.tobytes() for row in counts.astype(np.uint16)]


def _multiset(batch: pa.RecordBatch) -> pa.RecordBatch:
    found = texts(batch)
    counted = shingles(found)
    held = _counted_once(*counted, len(found))
    cells = _cells(*counted, len(found))
    return with_columns(batch, ["rid"], {"held": pa.array(held, pa.binary()), "cells": pa.array(cells, pa.binary())})


def _likely_pairs(first: int, last: int | None, batches):
    """Pairs of different classes whose coarse counts allow a link, the ``first`` to ``last`` of each text.

    Rows come ordered by (key, left, right): the texts of a bucket's two blocks, or
    of one block if both are the same. A pair is looked at in the first band that its texts
    share. A text's likely partners are numbered by what was known before the first turn, so
    every pair has its turn; a pair whose classes have met by then needs none. A row of -1
    says that pairs of later turns are left.
    """
    names = ("key", "left", "right", "block", "rid", "before", "class", "size", "cells", "bands")
    group, rows = None, []

    def compared():
        key, left, right = group
        rids, before, classes_, sizes = (np.array([r[k] for r in rows], np.int64) for k in (1, 2, 3, 4))
        blocks = np.array([r[0] for r in rows], np.int64)
        cells = np.frombuffer(b"".join(r[5] for r in rows), np.uint16).reshape(-1, CELLS)
        bands_ = np.array([r[6] for r in rows], np.int64)
        band = int(np.flatnonzero(bands_[0] == key)[0])
        full = (cells == MOST).all(axis=1)
        a, b, more = [], [], False
        for one in np.flatnonzero(blocks == left).tolist():
            others = before != before[one]
            others &= (np.arange(len(rows)) > one) if left == right else (blocks != left)
            others = np.flatnonzero(others)
            others = others[~(bands_[others, :band] == bands_[one, :band]).any(axis=1)]
            small = np.minimum(sizes[others], sizes[one])
            both = np.minimum(np.minimum(cells[others], cells[one]).sum(axis=1, dtype=np.int64), small)
            both = np.where(full[others] & full[one], small, both)
            likely = others[5 * both >= 4 * (sizes[others] + sizes[one] - both)]
            apart = classes_[likely] != classes_[one]
            turn = np.arange(len(likely)) >= first
            if last is not None:
                more = more or bool(apart[last:].any())
                turn &= np.arange(len(likely)) < last
            chosen = likely[apart & turn]
            a += [int(rids[one])] * len(chosen)
            b += rids[chosen].tolist()
        if more:
            a, b = [*a, -1], [*b, -1]
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    for batch in batches:
        for key, left, right, *row in zip(*(batch.column(c).to_pylist() for c in names), strict=True):
            if (key, left, right) != group:
                if len(rows) > 1:
                    yield compared()
                group, rows = (key, left, right), []
            rows.append(row)
    if len(rows) > 1:
        yield compared()


def _within_buckets(classed: DataFrame, coarse: DataFrame, first: int, last: int | None) -> DataFrame:
    """Likely links (a, b) between classes that share a bucket, those of one turn."""
    mixed = classed.groupBy("key").agg(
        F.min("class").alias("low"), F.max("class").alias("high"), F.count(F.lit(1)).alias("n")
    )
    mixed = mixed.filter("low < high").select("key", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
    held = classed.join(mixed, "key").join(coarse, "rid")
    held = held.withColumn("block", F.pmod(F.xxhash64("rid"), F.col("blocks")).cast("int"))
    held = held.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    held = held.select(
        "key", F.least("block", "other").alias("left"), F.greatest("block", "other").alias("right"),
        "block", "rid", "before", "class", "size", "cells", "bands",
    )
    spread = int(classed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = held.repartition(spread, "key", "left", "right").sortWithinPartitions("key", "left", "right", "rid")
    return ordered.mapInArrow(partial(_likely_pairs, first, last), "a long, b long")


def _similar(batch: pa.RecordBatch) -> pa.RecordBatch:
    good = []
    for a, b in zip(batch.column("held_a").to_pylist(), batch.column("held_b").to_pylist(), strict=True):
        a, b = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
        both = len(np.intersect1d(a, b, assume_unique=True))
        good.append(5 * both >= 4 * (len(a) + len(b) - both))  # both / union >= SIMILAR
    return with_columns(batch, ["a", "b"], {"linked": pa.array(good)})


def _verified(pairs: DataFrame, multisets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose exact similarity is SIMILAR or more."""
    first = multisets.select(F.col("rid").alias("a"), F.col("held").alias("held_a"))
    second = multisets.select(F.col("rid").alias("b"), F.col("held").alias("held_b"))
    both = pairs.join(first, "a").join(second, "b").select("a", "b", "held_a", "held_b")
    return map_batches(both, _similar, "a long, b long, linked boolean").filter("linked").select("a", "b")


def components(links: DataFrame) -> DataFrame:
    """(rid, class) of all ends of links: the least rid that links lead to."""
    ways = links.union(links.select("b", "a")).toDF("rid", "other").distinct()
    ways = stored(ways, "near-ways")
    labels = ways.groupBy("rid").agg(F.min("other").alias("near"))
    labels = stored(labels.select("rid", F.least("rid", "near").alias("class")), "near-labels")
    while True:
        # The least class next to a row, and then the class of that class.
        beside = ways.join(labels.select(F.col("rid").alias("other"), "class"), "other")
        beside = beside.groupBy("rid").agg(F.min("class").alias("beside"))
        nearer = labels.join(beside, "rid").select("rid", "class", F.least("class", "beside").alias("next"))
        above = labels.select(F.col("rid").alias("next"), F.col("class").alias("above"))
        moved = nearer.join(above, "next", "left").select(
            "rid", F.least("next", F.coalesce("above", "next")).alias("class"), F.col("class").alias("was")
        )
        moved = stored(moved, "near-labels")
        labels = moved.select("rid", "class")
        if moved.filter("class <> was").isEmpty():
            return labels


def classes(documents: DataFrame) -> DataFrame:
    """(rid, doc_id, class): every document's class, named by the rid of its first row."""
    small_batches(documents.sparkSession)
    rows = numbered(documents)
    kind = rows.schema["doc_id"].dataType.simpleString()
    sketches = stored(
        map_batches(rows, _sketch, f"rid long, doc_id {kind}, digest binary, bands array<long>"), "near-sketches"
    )
    firsts = sketches.groupBy("digest").agg(F.min("rid").alias("first"))
    members = sketches.select("rid", "doc_id", "digest").join(firsts, "digest").select("rid", "doc_id", "first")
    distinct = sketches.join(firsts.select(F.col("first").alias("rid")), "rid", "left_semi")
    keyed = distinct.select("rid", F.explode("bands").alias("key"))
    shared = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("key")
    buckets = stored(keyed.join(shared, "key").select("key", "rid"), "near-buckets")
    wanted = buckets.select("rid").distinct()
    multisets = stored(
        map_batches(rows.select("rid", "text").join(wanted, "rid"), _multiset, "rid long, held binary, cells binary"),
        "near-multisets",
    )

    def classed(labels: DataFrame | None) -> DataFrame:
        held = buckets if labels is None else buckets.join(labels, "rid", "left")
        named = F.col("rid") if labels is None else F.coalesce("class", "rid")
        return held.select("key", "rid", named.alias("class"))

    links, labels = None, None

    def linked(pairs: DataFrame) -> DataFrame:
        """Classes once the likely ``pairs`` are verified, too."""
        nonlocal links
        pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        found = stored(_verified(pairs, multisets), "near-links")
        if labels is not None and found.isEmpty():
            return labels
        links = found if links is None else links.union(found)
        return components(links)

    for pick in (F.min, F.max):
        held = classed(labels)
        led = held.groupBy("key").agg(
            pick(F.struct("rid", "class")).alias("lead"), F.min("class").alias("low"), F.max("class").alias("high")
        )
        pairs = held.join(led.filter("low < high").select("key", "lead"), "key").filter(F.col("class") != F.col("lead.class"))
        labels = linked(pairs.select(F.col("rid").alias("a"), F.col("lead.rid").alias("b")))
    before = labels.select("rid", F.col("class").alias("before"))
    coarse = multisets.select("rid", (F.octet_length("held") / 8).cast("long").alias("size"), "cells")
    coarse = coarse.join(sketches.select("rid", "bands"), "rid").join(before, "rid", "left")
    coarse = stored(coarse.withColumn("before", F.coalesce("before", "rid")), "near-coarse")
    for first, last in zip((0, *TURNS), (*TURNS, None), strict=True):
        pairs = stored(_within_buckets(classed(labels), coarse, first, last), "near-likely")
        likely = pairs.filter("a >= 0")
        if not likely.isEmpty():
            labels = linked(likely)
        if pairs.filter("a < 0").isEmpty():
            break
    named = members.join(labels.withColumnRenamed("rid", "first"), "first", "left")
    return named.select("rid", "doc_id", F.coalesce("class", "first").alias("class"))


def grouped(documents: DataFrame) -> DataFrame:
    """(doc_id, class_id, class_size, kept): the least doc_id of the class names it."""
    found = stored(classes(documents), "near-classes")
    names = found.groupBy("class").agg(F.min("doc_id").alias("class_id"), F.count(F.lit(1)).alias("class_size"))
    return found.join(names, "class").select(
        "doc_id", "class_id", "class_size", (F.col("rid") == F.col("class")).alias("kept")
    )


def keep_first(documents: DataFrame) -> DataFrame:
    """The first document of every class, with its columns as they were."""
    later = classes(documents).filter("rid <> class").select("rid")
    return packed(documents).join(later, "rid", "left_anti").select("row.*")
