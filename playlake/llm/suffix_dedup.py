"""Suffix-array dedup: bytes of strings of ``length`` bytes that start in two places.

Exact over the whole table, whatever the number of copies:

1. *Anchors.* In every string of ``length`` bytes the k-byte grams of least hash are
   anchors. Equal strings have equal anchors at equal offsets, so a repeated
   string shows at a repeated anchor. The strings around an anchor fall into two
   classes by its offset in them; all strings of a class share a *core*, the bytes
   common to them, and together they make a *segment* of less than one and a half times that length.
2. *Copies.* Segments with a core that occurs once are dropped. Segments that
   occur twice or more are repeated as a whole.
3. *Narrower classes.* The distinct segments of the other cores come together by core
   and are cut into ``fine`` classes by finer offsets, whose longer cores settle most
   strings as in 2.
4. *Interval expansion.* Narrow segments that still differ are joined, whole cores at
   a time, to one text, in which the core, the same in all of a group, is one symbol.
   The text is suffix-sorted, and the intervals of equal prefixes are extended
   backward through the Burrows-Wheeler order, one symbol a round, breadth first. A
   round splits intervals where their extensions differ, which gives the common
   prefixes by rising length; intervals that hold one suffix are left, and what
   stands at full length is repeated.
5. *Wide cores*, with more than ``NEAR`` segments, are not brought together: their segments
   are cut into two classes by the nearer and the farther offsets and grouped over all tasks
   by hashes, as in 1 and 2. Both classes have longer cores, which fewer segments share;
   those that are still wide are cut in two again, the others go on with 3. So a
   segment makes two rows for each time that its core is wide, at most four times. What
   can't be cut in two any more goes to 4 up to ``HOT`` segments; beyond,
   strings are settled one by one by grouping 128-bit hashes.

Strings never cross texts. Defined cases: a null text is empty; texts shorter than
``length`` have nothing to remove; strings of a text that overlap count as repeats if
they start in two places; repeated rows are copies of each other; an empty table
gives an empty result; other columns are not read by :func:`judged` and pass
unchanged through :func:`without_repeats`.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass, replace
from functools import partial
from itertools import groupby

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from playlake.llm.rows import map_batches, numbered, packed, small_batches, stored, texts, unpacked, with_columns

NEAR = 2_000  # distinct segments of a core that are brought together
HOT = 10_000  # distinct segments of a core that can't be cut in two, beyond which it is hot
TEXT_BYTES = 512 << 10
TASK_BYTES = 32 << 20
RANGE_ROWS = 10_000



@dataclass(frozen=True)
class Strings:
    """The strings looked for: ``length`` bytes, anchored by grams of ``k`` bytes (33 to 64).

    ``fine`` cuts a segment's strings into that many narrower classes; it divides half
    of the offsets that an anchor can have, over ``parts``, the number of classes that the
    segments were cut into already.
    """

    length: int
    k: int
    fine: int
    parts: int = 1

    def __post_init__(self):
        uneven = self.offsets % 4 or self.offsets // 2 % (self.parts * self.fine)
        if uneven or not 32 < self.k <= 64 or self.length + self.half >= 1024:
            raise ValueError(f"no classes of strings for {self}")

    @property
    def offsets(self) -> int:
        """Offsets an anchor can have in a string."""
        return self.length - self.k + 1

    @property
    def half(self) -> int:
        """Offsets of a class, which are also the strings of a segment."""
        return self.offsets // 2 // self.parts

    @property
    def core(self) -> int:
        """Bytes that all strings of a segment hold."""
        return self.length - self.half + 1

    @property
    def wide(self) -> int:
        """Strings of a narrower class."""
        return self.half // self.fine

    @property
    def long_core(self) -> int:
        """Bytes that all strings of a narrower class hold."""
        return self.length - self.wide + 1

    def in_two(self) -> tuple[Strings, Strings]:
        """This with two narrower classes, and their segments with classes no wider than here."""
        cuts = [n for n in range(1, self.half // 2 + 1) if self.half // 2 % n == 0]
        fine = next(n for n in cuts if self.half // 2 // n <= self.wide)
        return replace(self, fine=2), replace(self, parts=2 * self.parts, fine=fine)


WHOLE = Strings(length=400, k=49, fine=11)
#: Passages of some 50 words: what the pipeline cuts out.
PASSAGES = Strings(length=240, k=33, fine=8)

_BYTE_VALUES = np.random.default_rng(400).integers(0, 2**63, 256, dtype=np.uint64)


def _gram_hashes(data: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all k-byte grams, by doubling up to 32 bytes; two of those cover k."""
    x = _BYTE_VALUES[data]
    size = 1
    while size < 32:
        x = x[:-size] * np.uint64(0x9E3779B97F4A7C15) + x[size:]
        x ^= x >> np.uint64(29)
        size *= 2
    x = x[: len(data) - k + 1] * np.uint64(0xBF58476D1CE4E5B9) + x[k - 32 :]
    x ^= x >> np.uint64(32)
    return x * np.uint64(0x94D049BB133111EB)


def _sliding(x: np.ndarray, width: int, least) -> np.ndarray:
    """``least`` (np.minimum or np.maximum) over all windows of ``width``, by doubling."""
    size = 1
    while 2 * size <= width:
        x = least(x[:-size], x[size:])
        size *= 2
    return x if size == width else least(x[: len(x) - (width - size)], x[width - size :])


def anchors(text: bytes, w: Strings = WHOLE) -> np.ndarray:
    """Places of grams that are least in some string of w.length bytes; ties all count."""
    if len(text) < w.length:
        return np.zeros(0, np.int64)
    grams = _gram_hashes(np.frombuffer(text, np.uint8), w.k)
    least = _sliding(grams, w.offsets, np.minimum)
    around = np.zeros(len(least) + 2 * (w.offsets - 1), np.uint64)
    around[w.offsets - 1 : w.offsets - 1 + len(least)] = least
    return np.flatnonzero(_sliding(around, w.offsets, np.maximum) == grams)


def segments(text: bytes, w: Strings = WHOLE) -> set[tuple[int, int, int]]:
    """(core hash, segment hash, place) of a text, each once.

    A place holds the start, the length and the core's place in the segment; the
    latter two are below 1,024.
    """
    found, last, digest = set(), len(text) - w.length, xxhash.xxh3_64_intdigest
    for place in anchors(text, w).tolist():
        for core in (place, place - w.half):
            low, high = max(0, core - w.half + 1), min(core, last)
            if low <= high:
                skip = core - low
                key = digest(text[core : core + w.core], core != place)
                found.add((key, digest(text[low : high + w.length], skip), low << 20 | high - low + w.length << 10 | skip))
    return found


def _segment_batches(w: Strings, batches):
    for batch in batches:
        rids, found = [], []
        for rid, text in zip(batch.column("rid").to_pylist(), texts(batch), strict=True):
            some = segments(text, w)
            rids += [rid] * len(some)
            found += some
        cores, hashes, places = zip(*found, strict=True) if found else [()] * 3
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.array(cores, np.uint64).view(np.int64)),
                pa.array(np.array(hashes, np.uint64).view(np.int64)),
                pa.array(rids, pa.int64()),
                pa.array(places, pa.int64()),
            ],
            ["core", "segment", "rid", "place"],
        )


def suffix_order(symbols: np.ndarray, least: int) -> np.ndarray:
    """Suffixes in the order of their first ``least`` symbols or more, by prefix doubling."""
    size = len(symbols)
    padded = np.concatenate([symbols.astype(np.int64), np.zeros(3, np.int64)])
    key = padded[:size] << 42 | padded[1 : size + 1] << 21 | padded[2 : size + 2]
    width = 3
    while True:
        order = np.argsort(key, kind="stable")
        ranked = key[order]
        steps = np.concatenate([[0], np.cumsum(ranked[1:] != ranked[:-1])])
        if width >= least or steps[-1] == size - 1:
            return order
        rank = np.empty(size, np.int64)
        rank[order] = steps + 1
        key = rank * (size + 2)
        key[: size - width] += rank[width:]
        width *= 2


def repeated_starts(symbols: np.ndarray, length: int) -> np.ndarray:
    """Places where a string of ``length`` symbols starts that starts at another place too.

    Symbol 0 separates: strings don't hold it. ``onward[j]`` leads from a suffix to
    the one a symbol shorter: the prefix interval of a suffix after a backward
    extension is that of the shorter suffix, split by the symbol put before it. So
    two neighbours stay in one interval of ``n + 1`` symbols if they were in one of
    ``n`` and their shorter suffixes were, too.
    """
    size = len(symbols)
    order = suffix_order(symbols, length)
    place = np.empty(size + 1, np.int32)
    place[order] = np.arange(size, dtype=np.int32)
    place[size] = size
    onward = place[order + 1]
    first = symbols[order]
    # Interval numbers; a suffix alone in its interval has a negative number of its own.
    interval = -1 - np.arange(size + 1, dtype=np.int32)
    active = np.flatnonzero(first > 0).astype(np.int32)
    label = first[active].astype(np.int32)
    for _ in range(length - 1):  # labels are of one symbol so far
        if not len(active):
            break
        paired = _paired(label)
        if not paired.all():
            alone = active[~paired]
            interval[alone] = -1 - alone
            active, label = active[paired], label[paired]
        interval[active] = label
        # A round's intervals by (interval so far, interval of the shorter suffix).
        ahead = interval[onward[active]]
        change = np.ones(len(active), bool)
        change[1:] = (label[1:] != label[:-1]) | (ahead[1:] != ahead[:-1])
        label = np.cumsum(change, dtype=np.int32)
    return np.sort(order[active[_paired(label)]]) if len(active) else np.zeros(0, np.int64)


def _paired(label: np.ndarray) -> np.ndarray:
    """Which of the sorted labels occur twice or more."""
    same = label[1:] == label[:-1]
    out = np.zeros(len(label), bool)
    out[1:] |= same
    out[:-1] |= same
    return out


Range = tuple[int, int]


def _ranges(starts: np.ndarray, length: int) -> list[Range]:
    """Bytes under strings that start at the sorted places, as ranges that lie apart."""
    if not len(starts):
        return []
    breaks = np.flatnonzero(np.diff(starts) > length) + 1
    return [(int(part[0]), int(part[-1]) + length) for part in np.split(starts, breaks)]


def _compared(w: Strings, rows: list[tuple]) -> pa.RecordBatch:
    """Ranges of strings that start in two places of the rows' narrow segments.

    With its core as one symbol, a string has ``w.wide`` symbols, and equal strings
    hold the core at equal places. A place of a text stands once for each place of
    the core, so it is never equal to itself.
    """
    cores: dict[tuple[int, bytes], int] = {}  # the two classes of an anchor stay apart
    parts, begins, begin = [], [], 0
    for core, _, _, data, _, skip in rows:
        symbol = cores.setdefault((core, data[skip : skip + w.long_core]), 257 + len(cores))
        part = np.zeros(len(data) - w.long_core + 2, np.int32)
        bare = np.frombuffer(data, np.uint8)
        part[:skip] = bare[:skip]
        part[skip + 1 : -1] = bare[skip + w.long_core :]
        part[:-1] += 1
        part[skip] = symbol
        parts.append(part)
        begins.append(begin)
        begin += len(part)
    found = repeated_starts(np.concatenate(parts), w.wide)
    begins = np.array([*begins, begin])
    cuts = np.searchsorted(found, begins)
    rids, starts, ends = [], [], []
    for number, (_, rid, start, _, single, skip) in enumerate(rows):
        if single:
            inside = found[cuts[number] : cuts[number + 1]] - begins[number]
            # w.wide symbols that start behind the core are no string of this segment.
            for a, b in _ranges(inside[inside <= skip], w.length):
                rids.append(rid)
                starts.append(start + a)
                ends.append(start + b)
    return pa.RecordBatch.from_arrays(
        [pa.array(rids, pa.int64()), pa.array(starts, pa.int32()), pa.array(ends, pa.int32())], ["rid", "a", "b"]
    )


def _sorted_out(w: Strings, rows: list[tuple], found: list[tuple]) -> list[tuple]:
    """The narrow segments of a core that differ; ranges of those copied as a whole go to ``found``."""
    classes: dict[tuple[int, bytes], dict[tuple[int, bytes], list[tuple]]] = {}
    for _, rid, start, data, single, skip in rows:
        for part in range(w.fine):
            at = _narrow(w, len(data), skip, part)
            if at:
                first, last, held = at
                members = classes.setdefault((part, data[held : held + w.long_core]), {})
                members.setdefault((held - first, data[first : last + w.length]), []).append((rid, start + first, single))
    mixed = []
    for (part, _), members in classes.items():
        some = []
        for (held, whole), places in members.items():
            rid, start, single = places[0]
            alone = single and len(places) == 1
            some.append(((rows[0][0], part), rid, start, whole, alone, held))
            if not alone:
                found += [(rid, start, start + len(whole)) for rid, start, single in places if single]
        if len(some) > 1 and any(each[4] for each in some):
            mixed += some
    return mixed


_RANGES = {"rid": pa.int64(), "a": pa.int32(), "b": pa.int32()}


def _settled(w: Strings, batches):
    """Repeated ranges within whole cores, some at a time; rows come ordered by core."""
    names = ("core", "rid", "start", "data", "single", "skip")
    every = (row for batch in batches for row in zip(*(batch.column(c).to_pylist() for c in names), strict=True))
    rows, found, size = [], [], 0
    for _, members in groupby(every, lambda row: row[0]):
        mixed = _sorted_out(w, list(members), found)
        rows += mixed
        size += sum(len(each[3]) - w.long_core + 2 for each in mixed)
        if size >= TEXT_BYTES:
            yield _compared(w, rows)
            rows, size = [], 0
        if len(found) >= RANGE_ROWS:
            yield _columns(found, _RANGES)
            found = []
    if rows:
        yield _compared(w, rows)
    yield _columns(found, _RANGES)


def _cut_out(batch: pa.RecordBatch) -> pa.RecordBatch:
    """The bytes of the wanted segments of each text."""
    columns: dict[str, list] = {c: [] for c in ("core", "rid", "start", "data", "single", "skip")}
    wanted = batch.column("wanted").to_pylist()
    for rid, text, segs in zip(batch.column("rid").to_pylist(), texts(batch), wanted, strict=True):
        for seg in segs:
            columns["core"].append(seg["core"])
            columns["rid"].append(rid)
            columns["start"].append(seg["start"])
            columns["data"].append(text[seg["start"] : seg["start"] + seg["size"]])
            columns["single"].append(seg["single"])
            columns["skip"].append(seg["skip"])
    kinds = (pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.bool_(), pa.int32())
    arrays = [pa.array(v, kind) for v, kind in zip(columns.values(), kinds, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, list(columns))


def _columns(rows: list[tuple], kinds: dict[str, pa.DataType]) -> pa.RecordBatch:
    values = zip(*rows, strict=True) if rows else [()] * len(kinds)
    arrays = [pa.array(v, kind) for v, kind in zip(values, kinds.values(), strict=True)]
    return pa.RecordBatch.from_arrays(arrays, list(kinds))


def _narrow(w: Strings, size: int, skip: int, part: int) -> tuple[int, int, int] | None:
    """(first, last, core's place) of the strings of a narrower class, within the segment.

    Strings count by how far before the core they start: class ``part`` holds those
    of ``part * w.wide`` to ``part * w.wide + w.wide - 1`` bytes.
    """
    near, far = part * w.wide, part * w.wide + w.wide - 1
    first, last = max(0, skip - far), min(skip - near, size - w.length)
    return (first, last, skip - near) if first <= last else None


def _narrower(w: Strings, batch: pa.RecordBatch) -> pa.RecordBatch:
    """(piece, part, core, segment, rid, a, b, single) of the narrower classes of segments."""
    rows: list[tuple] = []
    names = ("piece", "core", "rid", "start", "data", "single", "skip")
    digest = xxhash.xxh3_64_intdigest
    signed = lambda x: x - 2**64 if x >= 2**63 else x
    for piece, core, rid, start, data, single, skip in zip(*(batch.column(c).to_pylist() for c in names), strict=True):
        for part in range(w.fine):
            found = _narrow(w, len(data), skip, part)
            if found:
                first, last, held = found
                longer = data[held : held + w.long_core]  # common to the class
                key = digest(longer, core % 2**64 + part & 2**64 - 1)
                whole = digest(data[first : last + w.length], held - first)
                rows.append((piece, part, signed(key), signed(whole), rid, start + first, start + last + w.length, single))
    kinds = {"piece": pa.int64(), "part": pa.int32(), "core": pa.int64(), "segment": pa.int64()}
    return _columns(rows, kinds | {"rid": pa.int64(), "a": pa.int32(), "b": pa.int32(), "single": pa.bool_()})


def _taken(w: Strings, batch: pa.RecordBatch) -> pa.RecordBatch:
    """The bytes of the wanted narrow segments."""
    rows: list[tuple] = []
    names = ("rid", "start", "data", "skip", "wanted")
    for rid, start, data, skip, wanted in zip(*(batch.column(c).to_pylist() for c in names), strict=True):
        for each in wanted:
            first, last, held = _narrow(w, len(data), skip, each["part"])
            part = data[first : last + w.length]
            rows.append((each["core"], rid, start + first, part, each["single"], held - first, each["many"]))
    kinds = {"core": pa.int64(), "rid": pa.int64(), "start": pa.int32(), "data": pa.binary()}
    return _columns(rows, kinds | {"single": pa.bool_(), "skip": pa.int32(), "many": pa.bool_()})


def _string_hashes(w: Strings, batch: pa.RecordBatch) -> pa.RecordBatch:
    """(core, string, rid, start, single) of every string of narrow segments."""
    rows: list[tuple] = []
    names = ("core", "rid", "start", "data", "single", "skip")
    for core, rid, start, data, single, skip in zip(*(batch.column(c).to_pylist() for c in names), strict=True):
        for place in range(len(data) - w.length + 1):
            # How far before the core a string starts is part of its name, see _compared.
            name = xxhash.xxh3_128_digest(data[place : place + w.length], abs(skip - place))
            rows.append((core, name, rid, start + place, single))
    kinds = {"core": pa.int64(), "string": pa.binary(), "rid": pa.int64(), "start": pa.int32(), "single": pa.bool_()}
    return _columns(rows, kinds)


def _of_hot_cores(w: Strings, hot: DataFrame) -> DataFrame:
    """Repeated ranges of narrow segments of hot cores."""
    strings = map_batches(hot, partial(_string_hashes, w), "core long, string binary, rid long, start int, single boolean")
    strings = stored(strings, "suffix-strings")
    weight = F.when(F.col("single"), 1).otherwise(2)
    again = strings.groupBy("core", "string").agg(F.sum(weight).alias("n")).filter("n > 1").drop("n")
    found = strings.filter("single").join(again, ["core", "string"])
    return found.select("rid", F.col("start").alias("a"), (F.col("start") + w.length).alias("b"))


def _of_wide_cores(w: Strings, cut: DataFrame) -> DataFrame:
    """Repeated ranges of single segments of cores with many others (a stored table)."""
    two, inner = w.in_two()
    last = inner.half % 2 == 1
    cut = cut.withColumn("piece", F.monotonically_increasing_id())
    classes = "piece long, part int, core long, segment long, rid long, a int, b int, single boolean"
    narrow = stored(map_batches(cut, partial(_narrower, two), classes), "suffix-narrow")
    weight = F.when(F.col("single"), 1).otherwise(2)
    distinct = stored(
        narrow.groupBy("core", "segment").agg(F.sum(weight).alias("n"), F.min(F.struct("piece", "part")).alias("at")),
        "suffix-narrow-distinct",
    )
    copied = distinct.filter("n > 1").select("core", "segment")
    whole = narrow.filter("single").join(copied, ["core", "segment"]).select("rid", "a", "b")
    mixed = distinct.groupBy("core").agg(F.count(F.lit(1)).alias("segments"), F.min("n").alias("least"))
    many = F.col("segments") > (HOT if last else NEAR)
    mixed = mixed.filter("segments > 1 and least = 1").select("core", many.alias("many"))
    wanted = distinct.join(mixed, "core").select(
        "at.piece", F.struct("core", "at.part", (F.col("n") == 1).alias("single"), "many").alias("w")
    )
    wanted = wanted.groupBy("piece").agg(F.collect_list("w").alias("wanted"))
    taken = stored(
        map_batches(
            cut.select("piece", "rid", "start", "data", "skip").join(wanted, "piece"),
            partial(_taken, two),
            "core long, rid long, start int, data binary, single boolean, skip int, many boolean",
        ),
        "suffix-compared",
    )
    near, wide = taken.filter("not many").drop("many"), taken.filter("many").drop("many")
    sums = taken.agg(F.sum(F.octet_length("data")).alias("bytes"), F.max("many").alias("many")).first()
    tasks = int(cut.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tasks = max(tasks, (sums.bytes or 0) // TASK_BYTES + 1)
    near = near.repartition(tasks, "core").sortWithinPartitions("core")
    found = whole.union(near.mapInArrow(partial(_settled, inner), "rid long, a int, b int"))
    if not sums.many:
        return found
    return found.union(_of_hot_cores(inner, wide) if last else _of_wide_cores(inner, wide))


def repeats(rows: DataFrame, w: Strings = WHOLE) -> DataFrame:
    """(rid, a, b): ranges that cover the repeated strings of all texts (rid, text)."""
    small_batches(rows.sparkSession)
    every = stored(
        rows.select("rid", "text").mapInArrow(partial(_segment_batches, w), "core long, segment long, rid long, place long"),
        "suffix-segments",
    )
    # Some cores come twice or more; the rest of the work sees only those. They are stored
    # first: joins of two plain shuffles are those that Spark splits at a hot core.
    again = every.groupBy("core").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("core")
    again = stored(again, "suffix-again")
    shared = stored(every.join(again, "core"), "suffix-shared")
    # Copies hold the same bytes, so any of them may stand for all; it is fixed by storing it.
    distinct = stored(
        shared.groupBy("core", "segment").agg(
            F.count(F.lit(1)).alias("n"), F.first("rid").alias("rid"), F.first("place").alias("place")
        ),
        "suffix-distinct",
    )
    start, size, skip = F.shiftright("place", 20), F.shiftright("place", 10) % 1024, F.col("place") % 1024
    copied = distinct.filter("n > 1").select("core", "segment")
    whole = shared.join(copied, ["core", "segment"]).select(
        "rid", start.cast("int").alias("a"), (start + size).cast("int").alias("b")
    )
    # A segment that is not copied as a whole may share strings with others of its core.
    mixed = distinct.groupBy("core").agg(
        F.count(F.lit(1)).alias("segments"), F.sum((F.col("n") == 1).cast("int")).alias("singles")
    )
    mixed = mixed.filter("segments > 1 and singles > 0").select("core", (F.col("segments") > NEAR).alias("wide"))
    mixed = stored(mixed, "suffix-mixed-cores")
    compared = stored(
        distinct.join(mixed, "core").select(
            "core", "rid", "wide", start.cast("int").alias("start"), size.cast("int").alias("size"),
            (F.col("n") == 1).alias("single"), skip.cast("int").alias("skip"),
        ),
        "suffix-mixed",
    )
    sums = compared.agg(F.sum("size").alias("bytes"), F.max("wide").alias("wide")).first()
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tasks = max(tasks, (sums.bytes or 0) // TASK_BYTES + 1)

    def cut(chosen: DataFrame) -> DataFrame:
        wanted = F.collect_list(F.struct("core", "start", "size", "single", "skip")).alias("wanted")
        return map_batches(
            rows.select("rid", "text").join(chosen.groupBy("rid").agg(wanted), "rid"),
            _cut_out,
            "core long, rid long, start int, data binary, single boolean, skip int",
        )

    near = cut(compared.filter("not wide")).repartition(tasks, "core").sortWithinPartitions("core")
    found = whole.union(near.mapInArrow(partial(_settled, w), "rid long, a int, b int"))
    return found.union(_of_wide_cores(w, stored(cut(compared.filter("wide")), "suffix-cut"))) if sums.wide else found


def _merged(ranges: list[dict] | None) -> list[Range]:
    """Ranges in order, those that touch as one."""
    out: list[list[int]] = []
    for a, b in sorted((r["a"], r["b"]) for r in ranges or ()):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def _kept(text: bytes, ranges: list[Range]) -> bytes:
    parts, last = [], 0
    for a, b in ranges:
        parts.append(text[last:a])
        last = b
    return b"".join([*parts, text[last:]])


def _with_ranges(rows: DataFrame, w: Strings) -> DataFrame:
    """``rows`` with the ranges to remove, null for none."""
    found = repeats(rows.select("rid", "text"), w)
    return rows.join(found.groupBy("rid").agg(F.collect_set(F.struct("a", "b")).alias("ranges")), "rid", "left")


def _judge(batch: pa.RecordBatch) -> pa.RecordBatch:
    sizes, removed, spans, digests = [], [], [], []
    for text, found in zip(texts(batch), batch.column("ranges").to_pylist(), strict=True):
        ranges = _merged(found)
        sizes.append(len(text))
        removed.append(sum(b - a for a, b in ranges))
        spans.append(len(ranges))
        digests.append(hashlib.sha256(_kept(text, ranges)).hexdigest())
    return with_columns(
        batch,
        ["doc_id"],
        {
            "n_bytes": pa.array(sizes, pa.int64()),
            "n_removed": pa.array(removed, pa.int64()),
            "n_spans": pa.array(spans, pa.int64()),
            "kept_sha256": pa.array(digests, pa.string()),
        },
    )


def judged(documents: DataFrame, w: Strings = WHOLE) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of every document."""
    rows = numbered(documents)
    kind = rows.schema["doc_id"].dataType.simpleString()
    return map_batches(
        _with_ranges(rows, w).select("doc_id", "text", "ranges"),
        _judge,
        f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string",
    )


def _remove(batch: pa.RecordBatch) -> pa.RecordBatch:
    left = [
        text if not found else _kept(text, _merged(found)).decode("utf-8", "ignore").encode()
        for text, found in zip(texts(batch), batch.column("ranges").to_pylist(), strict=True)
    ]
    return with_columns(batch, ["row"], {"text": pa.array(left, pa.binary()).cast(pa.string())})


def without_repeats(documents: DataFrame, w: Strings = WHOLE) -> DataFrame:
    """``documents`` with the repeated bytes cut out of ``text``; no row goes.

    Bytes of a character that was cut in part go, too; ``n_chars``, if there, is
    counted again for changed texts. A null text becomes empty.
    """
    rows = packed(documents).select("rid", "row", F.coalesce("row.text", F.lit("")).alias("text"))
    found = _with_ranges(rows, w).select("row", "text", "ranges")
    cut = map_batches(found, _remove, f"row {found.schema['row'].dataType.simpleString()}, text string")
    return unpacked(cut, documents)
