"""Plain versions of the text operators, for small tables."""

from __future__ import annotations

import re
from collections import Counter
from itertools import combinations

WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


def lower_words(text: str | None) -> list[bytes]:
    return WORD.findall((text or "").encode().lower())


def removed_bytes(texts: list[bytes], length: int) -> list[set[int]]:
    """Places under strings of ``length`` bytes that start in two places."""
    seen = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    return [
        {j for i in range(len(t) - length + 1) if seen[t[i : i + length]] > 1 for j in range(i, i + length)}
        for t in texts
    ]


def shingle_counts(text: str | None) -> Counter:
    words = lower_words(text)
    if not words:
        return Counter()
    return Counter(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def similarity(a: Counter, b: Counter) -> float:
    every = sum((a | b).values())
    return sum((a & b).values()) / every if every else 0.0


def near_classes(texts: list[str | None], similar: float = 0.8) -> list[int]:
    """For each text, the first text of its class."""
    bags = [shingle_counts(t) for t in texts]
    parent = list(range(len(texts)))

    def root(i: int) -> int:
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in combinations(range(len(texts)), 2):
        if bags[i] or bags[j]:
            same = similarity(bags[i], bags[j]) >= similar
        else:
            same = (texts[i] or "") == (texts[j] or "")
        if same:
            a, b = sorted((root(i), root(j)))
            parent[b] = a
    return [root(i) for i in range(len(texts))]


def hit_words(text: str | None, items: list[tuple[str, str | None]], width: int = 13) -> tuple[set[int], set[str]]:
    """(places of hit words, items whose windows occur)."""
    words, hit, found = lower_words(text), set(), set()
    for key, item in items:
        held = lower_words(item)
        size = min(width, len(held))
        windows = {tuple(held[i : i + size]) for i in range(len(held) - size + 1)} if held else set()
        for i in range(len(words) - size + 1):
            if windows and tuple(words[i : i + size]) in windows:
                hit.update(range(i, i + size))
                found.add(key)
    return hit, found
