"""Token counts: pieces per distinct pre-token, times pre-token frequencies per document.

No ids are made for documents. A text is cut into the tokenizer's pre-tokens,
which are counted per document; the number of pieces of a pre-token is worked out
once for the corpus and joined to the counts (see ``terms``).

The cut follows the tokenizer file: strings of added tokens are taken out first
and count one each; the rest is normalised (NFC, white space, lower case) and
split by the file's pattern. Stretches within Latin-1 are cut by a compiled
pattern over the lower-cased text, where normalising changes nothing else;
words with other characters go through the library's normaliser and splitter.

Defined cases: a null text is empty and has no token; repeated rows count alike,
each in a row of its own; an empty table gives an empty result; other columns are
not read.
"""

from __future__ import annotations

import json
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from tokenizers import Regex, Tokenizer, pre_tokenizers

from playlake.llm.rows import numbered, small_batches, stored, texts
from playlake.llm.terms import frequent_from, is_frequent

LIMIT = 2048

# The file's pattern for texts within Latin-1, after lower-casing.
_LETTERS = "a-zªµºß-öø-ÿ"
_NUMBERS = "0-9²³¹¼½¾"
_PATTERN = f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[{_NUMBERS}]|[^ \t-\r\x85\xa0{_LETTERS}{_NUMBERS}]+"


class PreTokens:
    """Cuts texts as a tokenizer file says, and counts the pieces of a pre-token."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        split = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.split = pre_tokenizers.Split(Regex(split), "removed", invert=True)
        self.bytes = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        added = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.added = re.compile("|".join(map(re.escape, added)))
        self.hints = {a[:2] for a in added}
        self.find = re.compile(_PATTERN).findall

    def _beyond(self, word: str) -> list[str]:
        """A word with other characters, by the library."""
        normal = self.tokenizer.normalizer.normalize_str(word)
        return [piece for piece, _ in self.split.pre_tokenize_str(normal)]

    def cut(self, text: str) -> tuple[list[str], int]:
        """(pre-tokens, added tokens) of a text."""
        extra = 0
        if any(hint in text for hint in self.hints):
            parts = self.added.split(text)
            extra = len(parts) - 1
        else:
            parts = [text]
        found: list[str] = []
        for part in parts:
            try:
                part.encode("latin-1")
            except UnicodeEncodeError:
                plain = []
                # ASCII white space parts pre-tokens and keeps normalising apart.
                for word in re.split("[ \t-\r]+", part):
                    try:
                        word.encode("latin-1")
                        plain.append(word)
                    except UnicodeEncodeError:
                        found += self._beyond(word)
                part = " ".join(plain)
            found += self.find(part.lower())
        return found, extra

    def pieces(self, term: str) -> int:
        """Pieces of one pre-token."""
        model = self.tokenizer.model
        return sum(len(model.tokenize(mapped)) for mapped, _ in self.bytes.pre_tokenize_str(term))


def term_counts(rows: DataFrame, path: str) -> DataFrame:
    """(term, n): how often each pre-token occurs."""

    def count(batches):
        cutter = PreTokens(path)
        for batch in batches:
            total: Counter[str] = Counter()
            for text in texts(batch):
                total.update(cutter.cut(text.decode())[0])
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], ["term", "n"]
            )

    parts = rows.mapInArrow(count, "term string, n long")
    return parts.groupBy("term").agg(F.sum("n").alias("n"))


def counted(documents: DataFrame, path: str, limit: int = LIMIT) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every document."""
    spark = documents.sparkSession
    small_batches(spark)
    rows = numbered(documents)
    counts = stored(term_counts(rows.select("text"), path), "pre-tokens")

    def values(batches):
        cutter = PreTokens(path)
        for batch in batches:
            pieces = [cutter.pieces(term) for term in batch.column("term").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("term"), pa.array(pieces, pa.int64())], ["term", "pieces"])

    least = frequent_from(counts)
    valued = lambda which: counts.filter(which).select("term").mapInArrow(values, "term string, pieces long")
    top = {row.term: row.pieces for row in valued(is_frequent(least)).collect()}
    table = spark.sparkContext.broadcast(top)

    def pairs(batches):
        cutter, get = PreTokens(path), table.value.get
        for batch in batches:
            rids = batch.column("rid").to_pylist()
            terms, times, places, sizes, known = [], [], [], [], []
            for place, text in enumerate(texts(batch)):
                found, total = cutter.cut(text.decode())
                for term, count in Counter(found).items():
                    pieces = get(term)
                    if pieces is None:
                        places.append(place)
                        terms.append(term)
                        times.append(count)
                    else:
                        total += count * pieces
                sizes.append(len(text))
                known.append(total)
            order = pa.array(list(range(len(rids))) + places, pa.int32())
            none = pa.nulls(len(places), pa.int64())
            # A document's own row has a key that no pre-token has: a space and its number.
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("rid").take(order),
                    pa.concat_arrays([batch.column("doc_id"), pa.nulls(len(places), batch.column("doc_id").type)]),
                    pa.array([f" {rid}" for rid in rids] + terms, pa.string()),
                    pa.array([0] * len(rids) + times, pa.int64()),
                    pa.concat_arrays([pa.array(sizes, pa.int64()), none]),
                    pa.concat_arrays([pa.array(known, pa.int64()), none]),
                ],
                ["rid", "doc_id", "term", "times", "n_bytes", "known"],
            )

    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"rid long, doc_id {kind}, term string, times long, n_bytes long, known long"
    joined = rows.mapInArrow(pairs, schema).join(valued(~is_frequent(least)), "term", "left")
    tokens = F.sum(F.coalesce(F.col("known"), F.col("times") * F.col("pieces")))
    return (
        joined.groupBy("rid")
        .agg(F.max("doc_id").alias("doc_id"), F.sum("n_bytes").alias("n_bytes"), tokens.alias("n_tokens"))
        .select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
    )
