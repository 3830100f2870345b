"""Levenshtein automata intersected with the trie of a lexicon."""

from __future__ import annotations

from collections.abc import Iterable

ROOT = 0


class FuzzyLexicon:
    """Reads a word letter by letter and tells which entries it is within their edit bound of.

    A state is the set of trie nodes that the letters so far can have reached, each with the fewest edits: the
    product of the trie with the Levenshtein automata of all entries at once. States are made when first
    reached and kept with what they accept, so a word then costs one look into a table per letter. ``kept`` bounds the number of
    states; beyond it the tables start anew.

    Entries are ``(text, is_stem, edits)``, the last their bound. A stem is met as soon as a word begins with it.
    """

    def __init__(self, entries: Iterable[tuple[str, bool, int]], kept: int = 50_000):
        self.entries = list(entries)
        self.kept = kept
        self.children: list[dict[str, int]] = [{}]
        self.whole: list[int | None] = [None]
        self.stem: list[int | None] = [None]
        # The largest bound of any entry at or below a node: more edits than that lead nowhere.
        self.bound = [0]
        for number, (text, is_stem, bound) in enumerate(self.entries):
            self.insert(number, text, is_stem, bound)
        self.begin()

    def insert(self, number: int, text: str, is_stem: bool, bound: int) -> None:
        node = ROOT
        self.bound[node] = max(self.bound[node], bound)
        for letter in text:
            if letter not in self.children[node]:
                self.children[node][letter] = len(self.children)
                self.children.append({})
                self.whole.append(None)
                self.stem.append(None)
                self.bound.append(0)
            node = self.children[node][letter]
            self.bound[node] = max(self.bound[node], bound)
        (self.stem if is_stem else self.whole)[node] = number

    def begin(self) -> None:
        self.numbers: dict[tuple[tuple[int, int], ...], int] = {}
        self.places: list[tuple[tuple[int, int], ...]] = []
        self.moves: list[dict[str, int]] = []
        # Entries with their edits that a state accepts: stems wherever it is met, whole words at a word's end.
        self.stems: list[tuple[tuple[int, int], ...]] = []
        self.wholes: list[tuple[tuple[int, int], ...]] = []
        self.state({ROOT: 0})

    def accepted(self, places: Iterable[tuple[int, int]], at: list[int | None]) -> tuple[tuple[int, int], ...]:
        return tuple((at[node], spent) for node, spent in places if at[node] is not None and spent <= self.entries[at[node]][2])

    def state(self, places: dict[int, int]) -> int:
        """The number of a state, closed under letters left out of the word."""
        stack = list(places.items())
        while stack:
            node, spent = stack.pop()
            for child in self.children[node].values():
                if spent + 1 <= self.bound[child] and places.get(child, 9) > spent + 1:
                    places[child] = spent + 1
                    stack.append((child, spent + 1))
        key = tuple(sorted(places.items()))
        if key not in self.numbers:
            self.numbers[key] = len(self.places)
            self.places.append(key)
            self.moves.append({})
            self.stems.append(self.accepted(key, self.stem))
            self.wholes.append(self.accepted(key, self.whole))
        return self.numbers[key]

    def step(self, state: int, letter: str) -> int:
        places: dict[int, int] = {}

        def reach(node: int, spent: int) -> None:
            if spent <= self.bound[node] and places.get(node, 9) > spent:
                places[node] = spent

        for node, spent in self.places[state]:
            reach(node, spent + 1)
            for label, child in self.children[node].items():
                reach(child, spent if label == letter else spent + 1)
        target = self.state(places)
        self.moves[state][letter] = target
        return target

    def matches(self, word: str) -> dict[int, int]:
        """All entries that ``word`` is within their bound of, with the fewest edits."""
        if len(self.places) > self.kept:
            self.begin()
        found: dict[int, int] = {}

        def note(entries: tuple[tuple[int, int], ...]) -> None:
            for entry, spent in entries:
                if found.get(entry, 9) > spent:
                    found[entry] = spent

        state = ROOT
        note(self.stems[state])
        for letter in word:
            target = self.moves[state].get(letter)
            state = self.step(state, letter) if target is None else target
            if not self.places[state]:
                return found
            note(self.stems[state])
        note(self.wholes[state])
        return found


def edits(text: str) -> int:
    """Edits allowed to an entry: none below four letters, two from ten."""
    return 0 if len(text) < 4 else 1 if len(text) < 10 else 2
