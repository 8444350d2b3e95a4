"""Generalised suffix automaton over word sequences, and matching statistics by it.

States hold the substrings of the items. Walking a text through the automaton
keeps, for each word, the longest substring of any item that ends there.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np


class Automaton:
    """Suffix automaton of several word sequences.

    ``words`` numbers the words of the items; ``step[s]`` maps a word's number to
    the next state; ``length[s]`` and ``link[s]`` are the longest substring and
    the suffix link. Size grows linearly with the words of the items.
    """

    def __init__(self, items: Iterable[list[bytes]]):
        self.words: dict[bytes, int] = {}
        self.step: list[dict[int, int]] = [{}]
        self.link: list[int] = [-1]
        self.length: list[int] = [0]
        for item in items:
            state = 0
            for word in item:
                state = self._extend(state, self.words.setdefault(word, len(self.words) + 1))

    def _split(self, state: int, word: int, target: int) -> int:
        """A state for the substrings of ``target`` no longer than through ``state``."""
        clone = len(self.step)
        self.step.append(dict(self.step[target]))
        self.link.append(self.link[target])
        self.length.append(self.length[state] + 1)
        self.link[target] = clone
        while state >= 0 and self.step[state].get(word) == target:
            self.step[state][word] = clone
            state = self.link[state]
        return clone

    def _extend(self, last: int, word: int) -> int:
        target = self.step[last].get(word)
        if target is not None:
            if self.length[target] == self.length[last] + 1:
                return target
            return self._split(last, word, target)
        new = len(self.step)
        self.step.append({})
        self.link.append(0)
        self.length.append(self.length[last] + 1)
        state = last
        while state >= 0 and word not in self.step[state]:
            self.step[state][word] = new
            state = self.link[state]
        if state >= 0:
            target = self.step[state][word]
            if self.length[target] == self.length[state] + 1:
                self.link[new] = target
            else:
                self.link[new] = self._split(state, word, target)
        return new

    def numbers(self, words: list[bytes]) -> list[int]:
        """The words as numbers; 0 for a word of no item."""
        get = self.words.get
        return [get(word, 0) for word in words]

    def runs(self, numbers: list[int], least: int) -> Iterator[tuple[int, int]]:
        """Stretches of known words, ``least`` or longer; shorter ones hold no match."""
        known = np.zeros(len(numbers) + 2, np.int8)
        known[1:-1] = np.asarray(numbers, np.int64) > 0
        turns = np.flatnonzero(np.diff(known))
        starts, ends = turns[::2], turns[1::2]
        far = ends - starts >= least
        yield from zip(starts[far].tolist(), ends[far].tolist(), strict=True)

    def walk(self, numbers: list[int], start: int, end: int) -> Iterator[tuple[int, int, int]]:
        """(place, state, matched length) for each word of a stretch."""
        step, link, length = self.step, self.link, self.length
        state = matched = 0
        for place in range(start, end):
            word = numbers[place]
            while state and word not in step[state]:
                state = link[state]
                matched = length[state]
            following = step[state].get(word)
            if following is None:
                state = matched = 0
            else:
                state = following
                matched += 1
            yield place, state, matched

    def shortened(self, state: int, length: int) -> int:
        """The state of the last ``length`` words of what ``state`` matched."""
        while self.length[self.link[state]] >= length:
            state = self.link[state]
        return state

    def find(self, numbers: list[int]) -> int:
        """The state of a whole substring."""
        state = 0
        for word in numbers:
            state = self.step[state][word]
        return state


class Windows:
    """Which marked substrings (windows) of the items end at a place of a text.

    A window is ``width`` consecutive words of an item, or a whole shorter item.
    """

    def __init__(self, items: list[tuple[object, list[bytes]]], width: int):
        items = [(key, words) for key, words in items if words]
        self.width = width
        self.automaton = Automaton(words for _, words in items)
        self.least = min([width, *(len(words) for _, words in items)])
        self.full: dict[int, set] = {}
        marks: dict[int, dict[int, set]] = {}
        for key, words in items:
            numbers = self.automaton.numbers(words)
            if len(numbers) < width:
                state = self.automaton.find(numbers)
                marks.setdefault(state, {}).setdefault(len(numbers), set()).add(key)
                continue
            for place, state, _ in self.automaton.walk(numbers, 0, len(numbers)):
                if place >= width - 1:
                    self.full.setdefault(self.automaton.shortened(state, width), set()).add(key)
        # For each state: the shorter items that are suffixes of what it holds, own and inherited.
        self.short: list[tuple | None] = [None] * len(self.automaton.step)
        if marks:
            for state in sorted(range(len(self.short)), key=self.automaton.length.__getitem__):
                above = self.short[self.automaton.link[state]] if state else None
                own = marks.get(state)
                self.short[state] = (state, tuple(sorted(own)), above) if own else above
        self.marks = marks

    def hits(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set]:
        """(covered spans of word places, in order and apart; keys of the items that occur)."""
        auto, width = self.automaton, self.width
        numbers = auto.numbers(words)
        spans: list[tuple[int, int]] = []
        states, shorts = set(), set()
        for start, end in auto.runs(numbers, self.least):
            for place, state, matched in auto.walk(numbers, start, end):
                reach = 0
                if matched >= width:
                    reach = matched
                    states.add(auto.shortened(state, width))
                mark = self.short[state]
                while mark is not None:
                    for size in mark[1]:
                        if size <= matched:
                            reach = max(reach, size)
                            shorts.add((mark[0], size))
                    mark = mark[2]
                if reach:
                    begin = place + 1 - reach
                    while spans and spans[-1][1] >= begin:
                        begin = min(begin, spans.pop()[0])
                    spans.append((begin, place + 1))
        found = set().union(*(self.full[s] for s in states))
        return spans, found.union(*(self.marks[s][n] for s, n in shorts))
