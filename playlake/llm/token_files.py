"""Token ids of documents in files of directly addressable codes.

An id is cut into chunks of bits, lowest first. Level 1 of a file holds the first
chunk of every id; a bit beside it says whether the id goes on, and then its next
chunk stands in the next level, at the place that the number of such bits before it
names. Counts of bits are kept for every ``BLOCK`` bits (the rank directory), so any
id of a file is read from a few bytes per level, and nothing is unpacked before it.
The widths of the levels are those that make the file smallest, from the number of
its ids per bit length.

File layout (little-endian)::

    magic "DACTOK01", count of sections (u32), JSON head length (u32), JSON head
    sections, each beginning at a multiple of 8 bytes:
      per level: chunks (bit-packed), continuation bits, rank directory (u64)
      ends of the documents (u64, in ids), document ids (an Arrow stream)

The head holds numbers of documents and ids, the widths, and each section's place and
size. Files are written by tasks over documents in the order of their ids, one after
the other of at most about ``FILE_IDS`` ids; a file's name is unique to the attempt that
wrote it, and the stored manifest names those of the attempts that count. So a task that
is lost, or runs twice, leaves at most a file that nobody reads.

Defined cases: a null text is empty: a document of the end id alone; documents of the
same id stay in the order of the table, null ids come first; an empty table gives an
empty manifest; a document is never split over files, so a file holds at least one, of
any length; texts are encoded word by word (between ASCII white space, where no
pre-token and no added token goes across), so of a very long text only the ids are held
at once, four bytes each; a word is held whole by the library. Other columns are not read.
"""

from __future__ import annotations

import io
import json
import os
import struct
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F
from tokenizers import Tokenizer, pre_tokenizers

from playlake.llm.rows import numbered, small_batches, stored, texts
from playlake.session import fresh_dir

END = 1
MAGIC = b"DACTOK01"
FILE_IDS = 8 << 20
BLOCK = 512  # bits per entry of a rank directory
MOST_LEVELS = 2
READ_IDS = 1 << 20
KEPT_WORDS = 300_000  # twice as many at most
MARKS = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


def _ends_in_letter(word: bytes) -> bool:
    """Whether the last character is a Latin-1 letter: normalising leaves those at the end what they are."""
    last = word.decode()[-1:]
    return last.isalpha() and last <= "\xff"


class Encoder:
    """The library's ids of texts, each distinct word worked out once for a while.

    For tokenizers that lower texts and never join pieces over white space. A word
    behind whose last letter only ASCII marks stand is looked up apart from them: the pattern
    always cuts between a letter and a mark. A-Z are lowered first, as the tokenizer does. A text
    that might hold an added token gets neither.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has the cores
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.known: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.hints = {token.content.encode()[:2] for token in added}
        mapped = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.mapped = {ord(c): mapped.pre_tokenize_str(c)[0][0] for c in map(chr, range(256)) if c.isalpha()}

    def _letters(self, word: str) -> bytes:
        """Ids of Latin-1 letters, which are one pre-token and change by lowering only."""
        found = self.tokenizer.model.tokenize(word.lower().translate(self.mapped))
        return np.array([token.id for token in found], "<u4").tobytes()

    def _learn(self, words: list[bytes]) -> None:
        """Have the library encode words, each by itself."""
        odd = []
        for word in words:
            text = word.decode()
            if len(word) <= 64 and text.isalpha() and max(text) <= "\xff":
                self.known[word] = self._letters(text)
            else:
                odd.append((word, text))
        if not odd:
            return
        found = self.tokenizer.encode([text for _, text in odd], is_pretokenized=True, add_special_tokens=False)
        ids = np.array(found.ids, "<u4").tobytes()
        owners = np.array(found.word_ids, np.int64)
        ends = (4 * np.cumsum(np.bincount(owners, minlength=len(odd)))).tolist()
        first = 0
        for (word, _), last in zip(odd, ends, strict=True):
            self.known[word] = ids[first:last]
            first = last

    def ids(self, text: bytes) -> np.ndarray:
        """Ids of a UTF-8 text."""
        plain = not any(hint in text for hint in self.hints)
        words = (text.lower() if plain else text).split()
        if len(self.known) >= KEPT_WORDS:
            self.known, self.older = {}, self.known
        known, older = self.known, self.older
        fresh, cut, wanted = set(words).difference(known), {}, set()
        for word in fresh:
            if word in older:
                known[word] = older[word]
                continue
            stem = word.rstrip(MARKS)
            if plain and stem != word and _ends_in_letter(stem):
                cut[word] = (stem, word[len(stem) :])
                wanted.update(cut[word])
            else:
                wanted.add(word)
        self._learn([w for w in wanted if w not in known])
        for word, (stem, marks) in cut.items():
            known[word] = known[stem] + known[marks]
        return np.frombuffer(b"".join(map(known.__getitem__, words)), "<u4")


@lru_cache(maxsize=1)
def encoder_of(path: str) -> Encoder:
    """One encoder for a worker process; tasks that follow each other share its words."""
    return Encoder(path)


def widths(lengths: np.ndarray) -> list[int]:
    """Chunk widths of the levels that need the fewest bits.

    ``lengths[b]`` is the number of ids of ``b`` bits. A level of width ``w`` that begins
    after ``b`` bits costs ``w`` bits for each longer id, and one more unless it is the last.
    """
    longest = max(1, int(np.flatnonzero(lengths).max(initial=1)))
    longer = [int(lengths[b + 1 :].sum()) for b in range(longest)]
    longer[0] = int(lengths.sum())  # an id of 0 needs a chunk, too
    # best[left][b] = (bits, widths) for what is left after b bits in at most `left` levels
    best: dict[tuple[int, int], tuple[int, list[int]]] = {}
    for left in range(1, MOST_LEVELS + 1):
        for b in range(longest - 1, -1, -1):
            options = [(longer[b] * (longest - b), [longest - b])]
            if left > 1:
                for w in range(1, longest - b):
                    rest, after = best[left - 1, b + w]
                    options.append((longer[b] * (w + 1) + rest, [w, *after]))
            best[left, b] = min(options)
    return best[MOST_LEVELS, 0][1]


def pack(values: np.ndarray, width: int) -> bytes:
    """Values of ``width`` bits each, one after the other, lowest bit first."""
    if width in (8, 16, 32):
        return values.astype(f"<u{width // 8}").tobytes()
    parts = []
    for at in range(0, len(values), READ_IDS):  # a multiple of 8 values ends at a byte
        bits = np.unpackbits(values[at : at + READ_IDS].astype("<u4").view(np.uint8).reshape(-1, 4), axis=1, bitorder="little")
        parts.append(np.packbits(bits[:, :width].ravel(), bitorder="little").tobytes())
    return b"".join(parts)


def unpack(data: np.ndarray, width: int, places: np.ndarray) -> np.ndarray:
    """The values at some places of packed bytes (with 8 bytes to spare behind them)."""
    bit = places.astype(np.int64) * width
    byte = bit >> 3
    found = np.zeros(len(places), np.uint64)
    for step in range((width + 7) // 8 + 1):
        found |= data[byte + step].astype(np.uint64) << np.uint64(8 * step)
    return (found >> (bit & 7).astype(np.uint64)) & np.uint64((1 << width) - 1)


def unpack_run(data: np.ndarray, width: int, first: int, count: int) -> np.ndarray:
    """``count`` values of packed bytes from place ``first`` on."""
    lead = first % 8  # eight values begin at a byte
    begin = (first - lead) * width // 8
    size = lead + count
    bits = np.unpackbits(data[begin : begin + -(-size * width // 8)], bitorder="little")[: size * width]
    wide = 8 if width <= 8 else 16 if width <= 16 else 32
    full = np.zeros((size, wide), np.uint8)
    full[:, :width] = bits.reshape(size, width)
    return np.packbits(full.ravel(), bitorder="little").view(f"<u{wide // 8}")[lead:].astype(np.uint32)


def directory(bits: np.ndarray) -> np.ndarray:
    """Set bits before every block of packed ``bits``."""
    size = BLOCK // 8
    full = np.zeros(-(-len(bits) // size) * size, np.uint8)
    full[: len(bits)] = bits
    counts = np.bitwise_count(full).reshape(-1, size).sum(axis=1, dtype=np.uint64)
    return np.concatenate([[np.uint64(0)], np.cumsum(counts, dtype=np.uint64)])


def encoded(ids: np.ndarray, ends: np.ndarray, docs: pa.Array) -> bytes:
    """A file of documents: their ids in one row, where each ends, and their names."""
    lengths = np.bincount(np.frexp(ids.astype(np.float64))[1], minlength=33)
    chosen = widths(lengths) if len(ids) else [1]
    sections: list[bytes] = []
    left = ids
    for number, width in enumerate(chosen):
        sections.append(pack(left & np.uint32((1 << width) - 1), width))
        rest = left >> np.uint32(width)
        goes_on = rest > 0
        if number + 1 < len(chosen):
            bits = np.packbits(goes_on, bitorder="little")
            sections += [bits.tobytes(), directory(bits).astype("<u8").tobytes()]
        left = rest[goes_on]
    sections.append(ends.astype("<u8").tobytes())
    sink = io.BytesIO()
    with pa.ipc.new_stream(sink, pa.schema([("doc_id", docs.type)])) as writer:
        writer.write_batch(pa.RecordBatch.from_arrays([docs], ["doc_id"]))
    sections.append(sink.getvalue())
    # Eight bytes behind each section, so that a value is read without looking for the end.
    sizes = [-(-(len(s) + 8) // 8) * 8 for s in sections]
    places = np.concatenate([[0], np.cumsum(sizes)[:-1]]).tolist()
    head = {"docs": len(ends), "ids": len(ids), "widths": chosen, "sections": [[int(p), len(s)] for p, s in zip(places, sections, strict=True)]}
    text = json.dumps(head).encode()
    text += b" " * (-(16 + len(text)) % 8)
    body = b"".join(s + bytes(size - len(s)) for s, size in zip(sections, sizes, strict=True))
    return MAGIC + struct.pack("<II", len(sections), len(text)) + text + body


class TokenFile:
    """A file of ids: any of them, any run of them, and its documents."""

    def __init__(self, data):
        held = np.frombuffer(data, np.uint8)
        if held[:8].tobytes() != MAGIC:
            raise ValueError("not a file of token ids")
        count, size = struct.unpack("<II", held[8:16].tobytes())
        head = json.loads(held[16 : 16 + size].tobytes())
        self.n_docs, self.n_ids, self.widths = head["docs"], head["ids"], head["widths"]
        body = held[16 + size :]
        sections = [body[at : at + length + 8] for at, length in head["sections"]]
        if len(sections) != count:
            raise ValueError("a file of token ids that is cut off")
        self.levels = []
        for number, width in enumerate(self.widths):
            chunks, bits, ranks = sections[3 * number], None, None
            if number + 1 < len(self.widths):
                bits = sections[3 * number + 1]
                ranks = sections[3 * number + 2][:-8].view("<u8")
            self.levels.append((width, chunks, bits, ranks))
        self.ends = sections[-2][:-8].view("<u8").astype(np.int64)
        self._docs = sections[-1][:-8]

    def docs(self) -> pa.Array:
        table = pa.ipc.open_stream(pa.py_buffer(self._docs.tobytes())).read_all()
        return table.column(0).combine_chunks()

    @staticmethod
    def _rank(bits: np.ndarray, ranks: np.ndarray, places: np.ndarray) -> np.ndarray:
        """Set bits before each place: the directory's count and those of the block's bytes."""
        block = places // BLOCK
        found = ranks[block].astype(np.int64)
        byte = block * (BLOCK // 8)
        last = places >> 3
        for _ in range(BLOCK // 8):
            inside = byte < last
            if not inside.any():
                break
            found += np.where(inside, np.bitwise_count(bits[np.where(inside, byte, 0)]), 0)
            byte = byte + 1
        part = bits[last] & ((np.uint16(1) << (places & 7).astype(np.uint16)) - 1).astype(np.uint8)
        return found + np.bitwise_count(part)

    def at(self, places) -> np.ndarray:
        """The ids at some places, each read by itself."""
        places = np.asarray(places, np.int64)
        if len(places) and not (0 <= places.min() and places.max() < self.n_ids):
            raise IndexError("no such token")
        found, still, shift = np.zeros(len(places), np.uint64), np.arange(len(places)), 0
        for width, chunks, bits, ranks in self.levels:
            found[still] |= unpack(chunks, width, places) << np.uint64(shift)
            if bits is None:
                break
            on = bits[places >> 3] >> (places & 7).astype(np.uint8) & 1 > 0
            still, places, shift = still[on], self._rank(bits, ranks, places[on]), shift + width
        return found.astype(np.uint32)

    def run(self, first: int, last: int) -> np.ndarray:
        """Ids ``first`` to ``last - 1``: chunks of a run stand together in every level."""
        if not 0 <= first <= last <= self.n_ids:
            raise IndexError("no such tokens")
        found, still, shift, count = np.zeros(last - first, np.uint32), np.arange(last - first), 0, last - first
        for width, chunks, bits, ranks in self.levels:
            if not count:
                break
            found[still] |= unpack_run(chunks, width, first, count) << np.uint32(shift)
            if bits is None:
                break
            span = np.unpackbits(bits[first >> 3 : (first + count + 7) >> 3], bitorder="little")
            on = span[first & 7 : (first & 7) + count] > 0
            first = int(self._rank(bits, ranks, np.array([first]))[0])
            still, shift = still[on], shift + width
            count = len(still)
        return found

    def document(self, number: int) -> np.ndarray:
        """Ids of one document."""
        return self.run(int(self.ends[number - 1]) if number else 0, int(self.ends[number]))


def _filesystem(directory: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a folder and the path there."""
    if "://" in directory or directory.startswith("file:"):
        if directory.startswith("file:") and not directory.startswith("file://"):
            directory = "file://" + directory.removeprefix("file:")
        return pafs.FileSystem.from_uri(directory)
    return pafs.LocalFileSystem(), directory


def open_file(path: str) -> TokenFile:
    """A file by path: mapped if it is local, else read."""
    system, place = _filesystem(path)
    if isinstance(system, pafs.LocalFileSystem):
        return TokenFile(pa.memory_map(place).read_buffer())
    with system.open_input_file(place) as file:
        return TokenFile(file.read_buffer())


MANIFEST = "part int, number int, file string, n_docs long, n_ids long"


def write_files(documents: DataFrame, path: str, directory: str, end: int = END, file_ids: int = FILE_IDS) -> DataFrame:
    """Write all documents' ids below ``directory``; the stored manifest of the files.

    Files follow each other by (part, number), documents by (doc_id, place in the table).
    """
    spark = documents.sparkSession
    small_batches(spark)
    rows = numbered(documents)
    kind = pa.schema([("doc_id", _arrow(rows, "doc_id"))]).field(0).type

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, number = encoder_of(path), TaskContext.get().partitionId(), 0
        system, base = _filesystem(directory)
        system.create_dir(base, recursive=True)
        held: list[np.ndarray] = []
        names: list[pa.Array] = []
        ends: list[int] = []
        total = 0

        def close() -> pa.RecordBatch:
            name = f"part-{part:05d}-{number:05d}-{uuid.uuid4().hex}.dac"
            docs = pa.chunked_array(names, kind).combine_chunks()
            content = encoded(np.concatenate(held), np.array(ends, np.int64), docs)
            with system.open_output_stream(f"{base}/{name}") as file:
                file.write(content)
            row = ([part], [number], [f"{directory}/{name}"], [len(ends)], [total])
            kinds = (pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64())
            arrays = [pa.array(v, t) for v, t in zip(row, kinds, strict=True)]
            return pa.RecordBatch.from_arrays(arrays, ["part", "number", "file", "n_docs", "n_ids"])

        for batch in batches:
            docs = batch.column("doc_id")
            for place, text in enumerate(texts(batch)):
                held += [encoder.ids(text), np.array([end], np.uint32)]
                total += len(held[-2]) + 1
                ends.append(total)
                names.append(docs.slice(place, 1))
                if total >= file_ids:
                    yield close()
                    held, names, ends, total, number = [], [], [], 0, number + 1
        if ends:
            yield close()

    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = rows.repartitionByRange(tasks, "doc_id", "rid").sortWithinPartitions("doc_id", "rid")
    return stored(ordered.mapInArrow(write, MANIFEST), "token-manifest")


def _arrow(frame: DataFrame, column: str) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(frame.schema[column].dataType)


def placed(manifest: DataFrame) -> DataFrame:
    """The manifest with each file's ``start``: ids in all files before it.

    Files of one part are few and summed by a window; the parts' totals, one number
    for each task that wrote, come together.
    """
    within = Window.partitionBy("part").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("n_ids").over(within), F.lit(0))
    totals = manifest.groupBy("part").agg(F.sum("n_ids").alias("n")).orderBy("part").collect()  # one row per task
    bases, total = [], 0
    for row in totals:
        bases.append((row.part, total))
        total += row.n
    base = manifest.sparkSession.createDataFrame(bases, "part int, base long")
    return manifest.join(base, "part").select("part", "number", "file", "n_docs", "n_ids", (F.col("base") + before).alias("start"))


def read_documents(manifest: DataFrame, kind: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of the documents in the files of a manifest."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start in zip(batch.column("file").to_pylist(), batch.column("start").to_pylist(), strict=True):
                file = open_file(path)
                ends = file.ends
                begins = np.concatenate([[0], ends[:-1]])
                yield pa.RecordBatch.from_arrays(
                    [
                        file.docs(),
                        pa.array(begins + start),
                        pa.array(ends - begins),
                        pa.array(_checksums(file, ends), pa.int64()),
                    ],
                    ["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    tasks = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = placed(manifest).select("file", "start").repartition(tasks, "file")
    return spread.mapInArrow(read, f"doc_id {kind}, start long, n_tokens long, ids_crc32 long")


def _checksums(file: TokenFile, ends: np.ndarray) -> list[int]:
    """crc32 of each document's ids, read in runs of READ_IDS."""
    sums, number, value = [], 0, 0
    for first in range(0, file.n_ids, READ_IDS):
        last = min(first + READ_IDS, file.n_ids)
        data = memoryview(file.run(first, last).astype("<u4").tobytes())
        at = first
        while number < len(ends) and ends[number] <= last:
            value = zlib.crc32(data[4 * (at - first) : 4 * (int(ends[number]) - first)], value)
            sums.append(value)
            at, value, number = int(ends[number]), 0, number + 1
        value = zlib.crc32(data[4 * (at - first) :], value)
    return sums


def listed(documents: DataFrame, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from files written and read again."""
    manifest = write_files(documents, path, fresh_dir(documents.sparkSession, "token-files"))
    return read_documents(manifest, documents.schema["doc_id"].dataType.simpleString())
