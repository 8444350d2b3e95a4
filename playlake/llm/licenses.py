"""License scans: matching statistics against licence texts, chained into spans.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after A-Z went to lower case. A
generalised suffix automaton holds the templates below and the base phrases. A
document streams through it; matches of ``LONG`` words or more are chained, in
order of both texts and over gaps of at most ``GAP`` words, into spans of one
template. A span that covers ``COVERED`` of its template gives its label; base
phrases give theirs wherever they stand.

Defined cases: a null text is empty and has no word; null places of a document
without a base phrase; ties between templates all count; repeated rows are scanned
each on its own; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from playlake.llm.automaton import Automaton
from playlake.llm.decontamination import words_of
from playlake.llm.rows import map_batches, numbered, small_batches, texts, with_columns

LONG = 6
GAP = 24
COVERED = 0.6

# Base phrases and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Passages of public licences that files quote.
TEMPLATES = (
    (
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the Software), to deal in the Software without restriction, including "
        "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
        "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
        "following conditions: The above copyright notice and this permission notice shall be included in all "
        "copies or substantial portions of the Software.",
    ),
    ("mit", "Released under the MIT License."),
    (
        "apache",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        "software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR "
        "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
        "permissions and limitations under the License.",
    ),
    ("apache", "Licensed under the Apache License, Version 2.0."),
    (
        "gpl",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, or "
        "(at your option) any later version. This program is distributed in the hope that it will be useful, but "
        "WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR "
        "PURPOSE. See the GNU General Public License for more details.",
    ),
    ("gpl", "This work is licensed under the GNU General Public License, version 3."),
    (
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met: Redistributions of source code must retain the above copyright "
        "notice, this list of conditions and the following disclaimer. Redistributions in binary form must "
        "reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
        "documentation and/or other materials provided with the distribution.",
    ),
    (
        "cc-by",
        "This work is licensed under a Creative Commons Attribution 4.0 International License. To view a copy of "
        "this license, visit http://creativecommons.org/licenses/by/4.0/",
    ),
    ("cc-by", "Licensed under CC BY-NC 4.0."),
)

SPAN = "struct<label:string,a:int,b:int,covered:double>"
_SPAN_TYPE = pa.list_(
    pa.struct([("label", pa.string()), ("a", pa.int32()), ("b", pa.int32()), ("covered", pa.float64())])
)
_PLACE_TYPE = pa.list_(pa.struct([("label", pa.string()), ("a", pa.int32())]))


class Scanner:
    """Finds base phrases and covered template spans in word lists."""

    def __init__(self, phrases=PHRASES, templates=TEMPLATES):
        self.labels = [label for label, _ in templates]
        held = [words_of(text.encode()) for _, text in templates]
        named = [(words_of(phrase.encode()), label) for phrase, label in phrases.items()]
        auto = self.automaton = Automaton([*held, *(words for words, _ in named)])
        self.sizes = [len(words) for words in held]
        self.long = [min(LONG, size) for size in self.sizes]
        # (template, end) pairs whose text up to the end has a state's substrings as suffixes.
        self.ends: dict[int, list[tuple[int, int]]] = {}
        for number, words in enumerate(held):
            for place, state, _ in auto.walk(auto.numbers(words), 0, len(words)):
                while state:
                    self.ends.setdefault(state, []).append((number, place + 1))
                    state = auto.link[state]
        self.marks: dict[int, list[tuple[int, str]]] = {}
        for words, label in named:
            self.marks.setdefault(auto.find(auto.numbers(words)), []).append((len(words), label))
        self.least = min([*self.long, *(len(words) for words, _ in named)])

    def _phrases_at(self, state: int, matched: int):
        link = self.automaton.link
        while state > 0:
            for size, label in self.marks.get(state, ()):
                if size <= matched:
                    yield size, label
            state = link[state]

    def scan(self, words: list[bytes]) -> tuple[list[tuple[str, int]], list[tuple[str, int, int, float]]]:
        """(base phrases as (label, start), template spans as (label, start, end, covered share))."""
        auto, least = self.automaton, min(self.long)
        numbers = auto.numbers(words)
        places: list[tuple[str, int]] = []
        matches: list[tuple[int, int, int]] = []  # end, state, length
        for start, end in auto.runs(numbers, self.least):
            before = None
            for place, state, matched in auto.walk(numbers, start, end):
                for size, label in self._phrases_at(state, matched):
                    places.append((label, place + 1 - size))
                if before and matched <= before[2] and before[2] >= least:
                    matches.append(before)
                before = place + 1, state, matched
            if before and before[2] >= least:
                matches.append(before)
        return places, self._chained(matches)

    def _chained(self, matches: list[tuple[int, int, int]]) -> list[tuple[str, int, int, float]]:
        """Matches of one template in the order of both texts, as spans."""
        open_: dict[int, list[int]] = {}  # template: start, end, its own end, words covered
        done: list[tuple[int, list[int]]] = []
        for end, state, size in matches:
            for template, own in self.ends.get(state, ()):
                if size < self.long[template]:
                    continue
                chain = open_.get(template)
                begins = end - size
                if chain and begins - chain[1] <= GAP and own > chain[2] and own - size >= chain[2] - size // 2:
                    chain[3] += own - max(chain[2], own - size)
                    chain[1], chain[2] = end, own
                elif not chain or begins >= chain[1] or size > chain[3]:
                    if chain:
                        done.append((template, chain))
                    open_[template] = [begins, end, own, size]
        done += open_.items()
        spans = {
            (self.labels[t], c[0], c[1], c[3] / self.sizes[t]) for t, c in done if c[3] >= COVERED * self.sizes[t]
        }
        return sorted(spans, key=lambda s: (s[1], s[2], s[0]))


def scanned(documents: DataFrame) -> DataFrame:
    """(doc_id, n_words, places, spans): base phrases and template spans, by word places."""
    small_batches(documents.sparkSession)
    rows = numbered(documents)
    made: dict[str, Scanner] = {}

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        scanner = made.get("scanner") or made.setdefault("scanner", Scanner())
        counts, places, spans = [], [], []
        for text in texts(batch):
            words = words_of(text)
            base, covered = scanner.scan(words)
            counts.append(len(words))
            places.append([{"label": label, "a": a} for label, a in base])
            spans.append([{"label": n, "a": a, "b": b, "covered": c} for n, a, b, c in covered])
        return with_columns(
            batch,
            ["doc_id"],
            {
                "n_words": pa.array(counts, pa.int64()),
                "places": pa.array(places, _PLACE_TYPE),
                "spans": pa.array(spans, _SPAN_TYPE),
            },
        )

    kind = rows.schema["doc_id"].dataType.simpleString()
    return map_batches(
        rows, work, f"doc_id {kind}, n_words long, places array<struct<label:string,a:int>>, spans array<{SPAN}>"
    )


def judged(documents: DataFrame) -> DataFrame:
    """One row per document: base places and labels, all labels, and a score.

    The score is 1 with a base phrase, else the best covered share of a span.
    """
    base = F.array_sort(F.array_distinct("places.label"))
    every = F.array_sort(F.array_union("places.label", "spans.label"))
    share = F.coalesce(F.array_max("spans.covered"), F.lit(0.0))
    return scanned(documents).select(
        "doc_id",
        "n_words",
        F.size("places").cast("long").alias("n_base"),
        F.array_min("places.a").cast("long").alias("first_word"),
        F.array_max("places.a").cast("long").alias("last_word"),
        F.array_join(base, ",").alias("base_labels"),
        F.array_join(every, ",").alias("labels"),
        F.when(F.size("places") > 0, F.lit(1.0)).otherwise(F.least(share, F.lit(1.0))).alias("score"),
        F.size("spans").cast("long").alias("n_spans"),
    )
