"""URL filters: longest host and path rule, else a block list held as sorted digests.

The block list's entries (hosts, standing for their subdomains too) are kept as a
sorted array of 64-bit xxhash keys beside the full strings. A task maps the array
from a file of its own, probes all hosts of a batch by one vectorised binary
search, and confirms a hit by the stored string, so a collision cannot block.
The list is taken in blocks of about ``BLOCK`` entries and ``BLOCK_BYTES`` at most,
by remainders of the key; each is sent to the executors by itself, so what is sent
is bounded for a list of any length.

Defined cases: a null url or one without ``://`` has an empty host and path, fits
no rule and is allowed; repeated rows are judged each on its own; empty pages give
an empty result, an empty list blocks nothing; other columns are not read.
"""

from __future__ import annotations

import mmap
import tempfile

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from playlake.llm.rows import small_batches

SEED = 42  # of Spark's xxhash64, which makes the keys
BLOCK = 1_000_000
BLOCK_BYTES = 64 << 20

# Verdict, host, path.
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)

# What names of unwanted hosts contain.
UNWANTED = ("ads-track", "adult-", "casino-", "cheap-pills", "free-bets", "spam-farm")


def host_and_path(pages: DataFrame) -> DataFrame:
    """(page_id, host, path) of each url."""
    after = F.regexp_extract(F.coalesce("url", F.lit("")), r"(?s)^.*?://(.*)$", 1)
    host = F.regexp_extract(after, r"(?s)^([^/?#]*)", 1)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return pages.select(
        "page_id",
        F.translate(host, upper, lower).alias("host"),
        F.regexp_extract(after, r"(?s)^[^/?#]*([^?#]*)", 1).alias("path"),
    )


def unwanted_hosts(pages: DataFrame) -> DataFrame:
    """Block list entries seen in the pages: a host from its unwanted label on."""
    names = "|".join(UNWANTED)
    entry = F.regexp_extract("host", rf"(?:^|\.)([^.]*(?:{names}).*)$", 1)
    return host_and_path(pages).select(entry.alias("entry")).filter("entry <> ''").distinct()


class DigestArray:
    """Sorted keys in a mapped file, and the strings they stand for."""

    def __init__(self, keys: bytes, strings: list[bytes]):
        self.strings = strings
        self.size = len(strings)
        with tempfile.TemporaryFile() as file:  # gone from the folder once opened
            file.write(keys or b"\0")
            file.flush()
            self.map = mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ)
        self.keys = np.frombuffer(self.map, np.uint64, self.size)

    def holds(self, probes: list[bytes]) -> np.ndarray:
        """Which of the strings are entries."""
        found = np.zeros(len(probes), bool)
        if not self.size or not probes:
            return found
        digests = np.fromiter((xxhash.xxh64_intdigest(p, SEED) for p in probes), np.uint64, len(probes))
        places = np.searchsorted(self.keys, digests)
        hits = np.flatnonzero(self.keys[np.minimum(places, self.size - 1)] == digests)
        for hit in hits.tolist():
            place = places[hit]
            while place < self.size and self.keys[place] == digests[hit]:
                if self.strings[place] == probes[hit]:
                    found[hit] = True
                    break
                place += 1
        return found


def _suffixes(host: bytes) -> list[bytes]:
    """The host and the domains above it."""
    parts = host.split(b".")
    return [b".".join(parts[k:]) for k in range(len(parts))]


def _probed(hosts: DataFrame, keys: bytes, strings: list[bytes]) -> DataFrame:
    """``hosts`` (host, listed), with ``listed`` set where this block has the host."""
    sent = hosts.sparkSession.sparkContext.broadcast((keys, strings))

    def run(batches):
        array = None
        for batch in batches:
            array = array or DigestArray(*sent.value)
            names = batch.column("host").cast(pa.binary()).to_pylist()
            probes = [_suffixes(n) for n in names]
            flat = [p for each in probes for p in each]
            counts = np.array([len(p) for p in probes])
            held = np.add.reduceat(array.holds(flat).astype(int), np.cumsum(counts) - counts) > 0
            was = batch.column("listed").to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("host"), batch.column("path"), pa.array(held | was)],
                ["page_id", "host", "path", "listed"],
            )

    kind = hosts.schema["page_id"].dataType.simpleString()
    return hosts.mapInArrow(run, f"page_id {kind}, host string, path string, listed boolean")


def _blocks(entries: DataFrame):
    """Sorted (keys, strings) of at most about BLOCK entries and BLOCK_BYTES each."""
    usable = entries.filter("entry is not null").select("entry", F.xxhash64("entry").alias("key")).distinct()
    size = usable.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("entry")).alias("bytes")).first()
    count = max(size.n // BLOCK, (size.bytes or 0) // BLOCK_BYTES) + 1
    for number in range(count):
        rows = usable.filter(F.pmod("key", F.lit(count)) == number).collect()
        rows = sorted((row.key % 2**64, row.entry.encode()) for row in rows)
        yield np.array([k for k, _ in rows], np.uint64).tobytes(), [s for _, s in rows]


def _rule():
    """The longest rule that fits, as a struct of its text and verdict."""
    longest = sorted(RULES, key=lambda r: -len(r[1] + r[2]))
    chosen = None
    for verdict, host, path in longest:
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(path)
        found = F.struct(F.lit(host + path).alias("rule"), F.lit(verdict).alias("verdict"))
        chosen = F.when(fits, found) if chosen is None else chosen.when(fits, found)
    return chosen


def judged(pages: DataFrame, entries: DataFrame) -> DataFrame:
    """(page_id, host, path, rule, verdict, listed) of every page.

    ``entries`` has one column ``entry``; null entries stand for nothing.
    """
    small_batches(pages.sparkSession)
    hosts = host_and_path(pages).withColumn("listed", F.lit(False))
    for keys, strings in _blocks(entries):
        hosts = _probed(hosts, keys, strings)
    return hosts.withColumn("chosen", _rule()).select(
        "page_id",
        "host",
        "path",
        F.col("chosen.rule").alias("rule"),
        F.coalesce(F.col("chosen.verdict"), F.when(F.col("listed"), "block").otherwise("allow")).alias("verdict"),
        "listed",
    )
