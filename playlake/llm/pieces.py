"""SentencePiece encoding that keeps offsets, and decoding.

A text is normalised through the model's compiled character map: at each place
the longest prefix the map's double-array trie holds is replaced, else one
character is copied. Every normalised byte records the source byte it came from,
so each piece is projected back to the byte span of the text it stands for.

Ids are those of the library. Where no piece can cross the start of a run of
spaces (checked on the vocabulary) and the map is empty, a text is encoded in
chunks, each a run of spaces and what follows up to the next; a distinct chunk is
encoded once per task and kept in a bounded table. Other models and texts with
the space mark itself are encoded whole.

Defined cases: a null text is empty and has no id; repeated rows are encoded each
on its own; an empty table gives an empty result; other columns are not read by
:func:`digested` and :func:`encoded`.
"""

from __future__ import annotations

import hashlib
import re
import struct
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from sentencepiece import sentencepiece_model_pb2

from playlake.llm.rows import numbered, small_batches, texts

SPACE = "▁".encode()
KEPT_CHUNKS = 250_000
LONGEST_CHUNK = 64  # bytes of a chunk that is kept
PLACES = list(range(LONGEST_CHUNK))
CHUNK = re.compile(rb" *[^ ]+| +")


class CharMap:
    """Longest-prefix replacement by a compiled character map."""

    def __init__(self, blob: bytes):
        self.units = np.zeros(0, np.uint32)
        self.strings = b""
        if blob:
            size = struct.unpack("<I", blob[:4])[0]
            self.units = np.frombuffer(blob[4 : 4 + size], "<u4")
            self.strings = blob[4 + size :]

    def __bool__(self) -> bool:
        return len(self.units) > 0

    def longest(self, text: bytes, start: int) -> tuple[int, bytes] | None:
        """(source bytes, replacement) of the longest entry that starts here."""
        if not self:
            return None
        units, found = self.units, None
        unit = int(units[0])
        node = (unit >> 10) << ((unit & 512) >> 6)
        for place in range(start, len(text)):
            node ^= text[place]
            if node >= len(units):
                break
            unit = int(units[node])
            if unit & 0x800000FF != text[place]:
                break
            node ^= (unit >> 10) << ((unit & 512) >> 6)
            if unit >> 8 & 1:
                found = place + 1 - start, int(units[node]) & 0x7FFFFFFF
        if found is None:
            return None
        return found[0], self.strings[found[1] : self.strings.index(b"\0", found[1])]


def _char_size(first: int) -> int:
    return 1 if first < 0xC0 else 2 if first < 0xE0 else 3 if first < 0xF0 else 4


class Normalizer:
    """The model's normaliser, with the source place of every normalised byte."""

    def __init__(self, blob: bytes, dummy_prefix: bool, remove_extra: bool, escape: bool):
        self.map = CharMap(blob)
        self.dummy_prefix, self.remove_extra = dummy_prefix, remove_extra
        self.space = SPACE if escape else b" "

    def run(self, text: bytes) -> tuple[bytes, list[int]]:
        """(normalised text, source place of each of its bytes and of its end)."""
        if text and not self.map and not self.remove_extra and b" " not in text:
            head = len(self.space) if self.dummy_prefix else 0
            places = PLACES[: len(text) + 1] if len(text) < len(PLACES) else list(range(len(text) + 1))
            return self.space[:head] + text, [0] * head + places
        prefixes, place = [], 0
        while place < len(text):
            found = self.map.longest(text, place)
            size, plain = found or (_char_size(text[place]), text[place : place + _char_size(text[place])])
            prefixes.append((place, size, plain))
            place += size
        if self.remove_extra:
            while prefixes and not prefixes[0][2].strip(b" "):
                prefixes.pop(0)
        if not prefixes:
            return b"", [0]
        out, source = bytearray(), []
        if self.dummy_prefix:
            out += self.space
            source += [prefixes[0][0]] * len(self.space)
        gap = self.remove_extra
        for start, size, plain in prefixes:
            if self.remove_extra and gap:
                plain = plain.lstrip(b" ")
            if not plain:
                continue
            gap = plain.endswith(b" ")
            piece = plain.replace(b" ", self.space)
            out += piece
            copied = text[start : start + size] == piece
            source += range(start, start + size) if copied else [start] * len(piece)
        end = prefixes[-1][0] + prefixes[-1][1]
        if self.remove_extra:
            while out.endswith(self.space):
                del out[-len(self.space) :]
                end = source[len(out)]
                del source[len(out) :]
        return bytes(out), [*source, end]


@dataclass(frozen=True)
class Pieces:
    """Pieces of numbered chunks, end to end: those of chunk n go from ``stops[n]`` to ``stops[n + 1]``."""

    stops: np.ndarray
    ids: np.ndarray
    ends: np.ndarray  # of each piece's bytes, within the chunk

    @staticmethod
    def by_counts(counts: np.ndarray, ids: np.ndarray, ends: np.ndarray) -> Pieces:
        return Pieces(np.concatenate([[0], np.cumsum(counts)]), ids.astype(np.int32), ends.astype(np.int32))

    def __len__(self) -> int:
        return len(self.stops) - 1

    def of(self, numbers: np.ndarray) -> Pieces:
        """Pieces of these chunks, in their order."""
        firsts = self.stops[numbers]
        counts = self.stops[numbers + 1] - firsts
        stops = np.concatenate([[0], np.cumsum(counts)])
        at = np.repeat(firsts - stops[:-1], counts) + np.arange(stops[-1])
        return Pieces(stops, self.ids[at], self.ends[at])

    def __add__(self, other: Pieces) -> Pieces:
        return Pieces(
            np.concatenate([self.stops, other.stops[1:] + self.stops[-1]]),
            np.concatenate([self.ids, other.ids]),
            np.concatenate([self.ends, other.ends]),
        )


class Codec:
    """Encodes texts to (ids, byte spans) and decodes ids."""

    def __init__(self, path: str):
        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(self.library.serialized_model_proto())
        spec = proto.normalizer_spec
        self.normalizer = Normalizer(
            spec.precompiled_charsmap, spec.add_dummy_prefix, spec.remove_extra_whitespaces, spec.escape_whitespaces
        )
        names = [piece.piece for piece in proto.pieces]
        self.widths = np.array(
            [1 if self.library.is_byte(k) else len(name.encode()) for k, name in enumerate(names)], np.int64
        )
        crossing = any("▁" in name.lstrip("▁") or " " in name for name in names)
        own = any(piece.type == 4 for piece in proto.pieces)  # user-defined
        self.chunked = not (
            crossing or own or self.normalizer.map or spec.remove_extra_whitespaces or not spec.add_dummy_prefix
        )
        self.names = list(map(str, range(len(names))))
        # A last space alone: the library gets nothing of it, and gives nothing.
        space = self.library.piece_to_id("▁")
        self.last_space = Pieces.by_counts(np.array([1]), np.array([space]), np.array([0]))
        # Numbers of the chunks that are kept, and their pieces; those of the table before.
        self.kept, self.pieces = {b"": 0}, self.last_space
        self.older, self.older_pieces = self.kept, self.pieces

    def _spans(self, ids: list[int], source: list[int]) -> list[int]:
        """End of each piece's bytes in the source."""
        ends = np.cumsum(self.widths[np.array(ids, np.int64)])
        return np.array(source)[np.minimum(ends, len(source) - 1)].tolist()

    def _whole(self, chunks: list[bytes], found: list[list[int]]) -> Pieces:
        """Pieces of chunks that are normalised one by one."""
        ends = []
        for chunk, ids in zip(chunks, found, strict=True):
            ends += self._spans(ids, self.normalizer.run(chunk)[1])
        counts = np.fromiter(map(len, found), np.int64, len(found))
        return Pieces.by_counts(counts, np.array(list(chain.from_iterable(found)), np.int32), np.array(ends, np.int32))

    def _leading(self, chunks: list[bytes], found: list[list[int]]) -> Pieces:
        """Pieces of chunks whose spaces all lead, as :meth:`_whole` gives them."""
        counts = np.fromiter(map(len, found), np.int64, len(found))
        sizes = np.fromiter(map(len, chunks), np.int64, len(chunks))
        spaces = np.array([len(c) - len(c.lstrip(b" ")) if c[:1] == b" " else 0 for c in chunks], np.int64)
        ids = np.fromiter(chain.from_iterable(found), np.int32, int(counts.sum()))
        places = np.cumsum(self.widths[ids])
        stops = np.cumsum(counts)
        before = np.concatenate([[0], places])[stops - counts]
        # Past the library's own space; then each space of the chunk is as wide as the mark.
        wide = len(self.normalizer.space)
        places -= np.repeat(before, counts) + wide
        lead = np.repeat(spaces, counts)
        places = np.where(places < lead * wide, np.maximum(places, 0) // wide, places - lead * (wide - 1))
        return Pieces.by_counts(counts, ids, np.minimum(places, np.repeat(sizes, counts)))

    def _encoded(self, chunks: list[bytes]) -> tuple[list[bytes], Pieces]:
        """Chunks, in an order of their own, and their pieces."""
        whole = [c for c in chunks if SPACE in c] if self.chunked else chunks
        found = self.library.encode([c.decode() for c in whole], num_threads=1)
        pieces = self._whole(whole, found)
        if len(whole) == len(chunks):
            return whole, pieces
        rest = [c for c in chunks if SPACE not in c] if whole else chunks
        found = self.library.encode([c.decode() for c in rest], num_threads=1)
        return whole + rest, pieces + self._leading(rest, found)

    def _chunks(self, text: bytes) -> list[bytes]:
        """Chunks as the library gets them: its own leading space stands for one of theirs."""
        if not text:
            return []
        if not self.chunked or SPACE in text:
            return [text]
        if b"  " not in text and not text.startswith(b" "):
            return text.split(b" ")
        found = CHUNK.findall(text)
        return found[:1] + [chunk[1:] for chunk in found[1:]]

    def _numbers(self, distinct: list[bytes]) -> tuple[np.ndarray, Pieces]:
        """A number for each chunk, and the pieces by those numbers.

        Each chunk is encoded once per table; long ones are not kept, as few come again.
        """
        if len(self.kept) > KEPT_CHUNKS:  # chunks that still come are taken over from the older table
            self.older, self.older_pieces = self.kept, self.pieces
            self.kept, self.pieces = {b"": 0}, self.last_space
        kept, older = self.kept, self.older
        fresh = [chunk for chunk in distinct if chunk not in kept]
        again = [chunk for chunk in fresh if chunk in older]
        if again:
            self.pieces += self.older_pieces.of(np.array([older[chunk] for chunk in again]))
            kept.update(zip(again, range(len(kept), len(kept) + len(again)), strict=True))
            fresh = [chunk for chunk in fresh if chunk not in older]
        short, pieces = self._encoded([chunk for chunk in fresh if len(chunk) <= LONGEST_CHUNK])
        self.pieces += pieces
        kept.update(zip(short, range(len(kept), len(kept) + len(short)), strict=True))
        if len(short) == len(fresh):
            return np.fromiter(map(kept.__getitem__, distinct), np.int64, len(distinct)), self.pieces
        long, pieces = self._encoded([chunk for chunk in fresh if len(chunk) > LONGEST_CHUNK])
        passing = dict(zip(long, range(len(kept), len(kept) + len(long)), strict=True))
        numbers = [kept[chunk] if chunk in kept else passing[chunk] for chunk in distinct]
        return np.array(numbers, np.int64), self.pieces + pieces

    def aligned(self, found: list[bytes]):
        """Yield (ids, ends of their byte spans) for each text, as arrays.

        Distinct chunks are looked up once for all texts; their pieces are copied to the
        places where they stand in one go, without an object for each.
        """
        chunks = [self._chunks(text) for text in found]
        parts = np.fromiter(map(len, chunks), np.int64, len(chunks))
        spelled = pa.array(chain.from_iterable(chunks), pa.large_binary()).dictionary_encode()
        numbers, pieces = self._numbers(spelled.dictionary.to_pylist())
        which = spelled.indices.to_numpy(zero_copy_only=False)
        pieces = pieces.of(numbers[which])
        # Places of the chunks in their texts; a chunk after the first lost one space to the library.
        places = np.concatenate([[0], np.cumsum(pc.binary_length(spelled.dictionary).to_numpy()[which] + 1)])
        last = np.cumsum(parts)
        places = places[:-1] - np.repeat(places[last - parts], parts)
        ends = (pieces.ends + np.repeat(places, np.diff(pieces.stops))).astype(np.int32)
        stops = pieces.stops[last]
        start = 0
        for stop in stops.tolist():
            yield pieces.ids[start:stop], ends[start:stop]
            start = stop

    def encode(self, found: list[bytes]):
        """Yield (ids, ends of their byte spans) for each text."""
        for ids, ends in self.aligned(found):
            yield ids.tolist(), ends.tolist()

    def decode(self, ids: list[int]) -> str:
        return self.library.decode(ids) if ids else ""


def _digests(codec: Codec, batch: pa.RecordBatch):
    """Yield (ids, ends, digest of the ids as text, digest of the decoded text) of a batch's texts."""
    names = codec.names
    for ids, ends in codec.aligned(texts(batch)):
        some = ids.tolist()
        written = ",".join([names[k] for k in some])
        decoded = codec.decode(some)
        yield ids, ends, hashlib.sha256(written.encode()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()


def encoded(documents: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids, ends, n_tokens, ids_sha256, decoded_sha256) of every document.

    ``ids`` are piece ids, ``ends`` the end of each piece's byte span in the text, and
    the digests are of the ids and of the text decoded from them. Spans follow each
    other: a piece starts where the one before it ends.
    """
    small_batches(documents.sparkSession)
    rows = numbered(documents)

    def run(batches):
        codec = Codec(path)
        for batch in batches:
            ids, ends, ids_sha, decoded_sha = zip(*_digests(codec, batch), strict=True) if batch.num_rows else [()] * 4
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(ids, pa.list_(pa.int32())),
                    pa.array(ends, pa.list_(pa.int32())),
                    pa.array(map(len, ids), pa.int64()),
                    pa.array(ids_sha, pa.string()),
                    pa.array(decoded_sha, pa.string()),
                ],
                ["doc_id", "ids", "ends", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(
        run,
        f"doc_id {kind}, ids array<int>, ends array<int>, n_tokens long, ids_sha256 string, decoded_sha256 string",
    )


def digested(documents: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256, n_covered): ids and decoded text as digests.

    ``n_covered`` counts the text's bytes within the pieces' spans.
    """
    small_batches(documents.sparkSession)
    rows = numbered(documents)

    def run(batches):
        codec = Codec(path)
        for batch in batches:
            sizes, ids_sha, decoded_sha, covered = [], [], [], []
            for ids, ends, digest, decoded in _digests(codec, batch):
                sizes.append(len(ids))
                ids_sha.append(digest)
                decoded_sha.append(decoded)
                covered.append(int(ends[-1]) if len(ends) else 0)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(sizes, pa.int64()),
                    pa.array(ids_sha, pa.string()),
                    pa.array(decoded_sha, pa.string()),
                    pa.array(covered, pa.int64()),
                ],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "n_covered"],
            )

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(
        run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string, n_covered long"
    )
