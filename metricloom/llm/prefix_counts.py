"""Exact token counts of every prefix of a text, by dynamic programming.

BPE has the property that the tokens of a text, less the last one, are the tokens of what they spell. So the
tokens of a prefix are known by its last token alone: it is the one token ending there that may follow the last
token of the prefix before it, and its count is that prefix's count plus one. One pass over a word gives the last
token and the count of all its prefixes, each also with the end-of-word mark that a text cut there would have.
Which token may follow which is told by the automaton of ``bpe``.

A prefix ends anywhere between two code points. Its count may be lower than that of a shorter prefix (``hell``
may be two tokens and ``hello`` one), so a table holds the differences from prefix to prefix, one signed byte for
each code point, or four bytes where a difference does not fit. Answers about truncation and budgets come from
stored tables; the texts are not read again.

Pieces never cross a blank, so chunks between blanks have tables of their own, which are kept while there is room.
A chunk is cut where letters, digits and marks meet below U+0250; a run with other letters is split by the library's
rules, and one whose letters are not composed, or change in number when lowered, is counted prefix by prefix, which
takes time with the square of that run's length.

Defined results: a null or empty text has an empty table and no tokens. Texts of any length are read whole; a text's
table is built in one task and is about as long as the text. The vocabulary's special strings count as one token once complete.
Repeated rows give repeated results, ties do not arise, an empty table gives no rows, and other columns are ignored.
"""

from __future__ import annotations

import unicodedata
from array import array
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from metricloom.llm.bpe import LONGEST_KEPT, Automaton, load_automaton, plain_word
from metricloom.llm.common import Shared, map_arrow, text_or_empty

LIMIT = 2048
# Letters from here on may combine with those before them.
SIMPLE_BELOW = 0x250
# The first byte of a table: bytes per difference.
NARROW, WIDE = b"\x01", b"\x04"


def simple_classes() -> str:
    """For each letter below ``SIMPLE_BELOW``: L letter, N number, P mark; ``?`` for white space, of which libraries differ."""
    out = ""
    for c in map(chr, range(SIMPLE_BELOW)):
        if c.isspace() or regex.match(r"\s", c) or len(c.lower()) != 1:
            out += "?"
        else:
            out += "L" if regex.match(r"\p{L}", c) else "N" if regex.match(r"\p{N}", c) else "P"
    return out


class Kept(dict[str, bytes]):
    """Differences of the chunks met so far, as signed bytes."""

    def __init__(self, counter: PrefixCounter):
        super().__init__()
        self.counter = counter

    def __missing__(self, chunk: str) -> bytes:
        found = array("b", self.counter.chunk(chunk)).tobytes()
        if len(self) < self.counter.room and len(chunk) <= LONGEST_KEPT:
            self[chunk] = found
        return found


class PrefixCounter:
    """Counts tokens of all prefixes by the tables of an automaton; ``room`` bounds the chunks and words remembered."""

    UNSHIPPED = ("kept", "pieces", "library", "classes", "labels")

    def __init__(self, automaton: Automaton, definition: str, room: int = 500_000):
        self.automaton, self.definition, self.room = automaton, definition, room
        self.ready()

    def ready(self) -> None:
        self.kept = Kept(self)
        self.pieces: dict[str, list[int]] = {}
        self.classes = simple_classes()
        # By label the token inside a word and the one at its end, -1 for none; what begins no label is missing.
        inside, ending = self.automaton.inner, self.automaton.final
        begun = {label[:k] for label in (*inside, *ending) for k in range(1, len(label) + 1)}
        self.labels = {b: (inside.get(b, -1), ending.get(b, -1)) for b in begun}
        self.library = Tokenizer.from_str(self.definition)
        self.library.no_truncation()
        self.library.no_padding()

    def __getstate__(self) -> dict[str, object]:
        return {k: v for k, v in self.__dict__.items() if k not in self.UNSHIPPED}

    def __setstate__(self, state: dict[str, object]) -> None:
        self.__dict__.update(state)
        self.ready()

    def table(self, text: str) -> bytes:
        """The first byte tells the width; then one difference for each code point."""
        if len(self.kept) >= self.room:
            self.kept.clear()
        chunks = text.replace("\n", " ").replace("\r", " ").replace("\t", " ").split(" ") if text else []
        try:
            return NARROW + b"\0".join(map(self.kept.__getitem__, chunks))
        except OverflowError:
            return WIDE + np.concatenate([[*self.chunk(c), 0] for c in chunks])[:-1].astype("<i4").tobytes()

    def by_library(self, text: str) -> int:
        return len(self.library.encode(text, add_special_tokens=False).ids)

    def chunk(self, chunk: str) -> list[int]:
        """Differences for each code point of what stands between two blanks."""
        if not chunk:
            return []
        plain = plain_word(chunk)
        if plain is not None:
            return self.piece(plain[0]) + [1] * len(plain[1])
        special = self.automaton.special_split.search(chunk) if "<|" in chunk and self.automaton.special_split else None
        if special is None:
            return [d for a, b in self.cuts(chunk) for d in self.segment(chunk[a:b])]
        before, name, after = chunk[: special.start()], special[0], chunk[special.end() :]
        # While the name is incomplete, it is marks and letters like any others.
        tail = before[self.cuts(before)[-1][0] :] if before else ""
        partial = [self.by_library(tail + name[:k]) for k in range(len(name))]
        partial.append(partial[0] + 1)
        return [*self.chunk(before), *np.diff(partial).tolist(), *self.chunk(after)]

    def cuts(self, chunk: str) -> list[tuple[int, int]]:
        """Parts that have nothing to do with each other, whatever prefix is asked for."""
        kinds = [self.classes[ord(c)] if ord(c) < SIMPLE_BELOW else "?" for c in chunk]
        # What follows an apostrophe may belong to it.
        at = [
            p
            for p in range(1, len(chunk))
            if "?" not in (kinds[p - 1], kinds[p]) and (kinds[p - 1] != kinds[p] or kinds[p] == "N") and chunk[p - 1] != "'"
        ]
        return list(zip([0, *at], [*at, len(chunk)], strict=True))

    def segment(self, part: str) -> list[int]:
        if all(ord(c) < SIMPLE_BELOW for c in part) and len({self.classes[ord(c)] for c in part} - {"N"}) <= 1:
            kind = {self.classes[ord(c)] for c in part}
            if kind == {"L"} or kind == {"P"} or (kind == {"N"} and len(part) == 1):
                return self.piece(part.lower())
        normalise = self.automaton.rules.normalizer.normalize_str
        lowered, single = normalise(part), [normalise(c) for c in part]
        if not unicodedata.is_normalized("NFC", part) or max(map(len, single)) > 1 or "".join(single) != lowered:
            return np.diff([0, *(self.by_library(part[:k]) for k in range(1, len(part) + 1))]).tolist()
        out = [0] * len(part)
        for _, (a, b) in self.automaton.rules.pre_tokenizer.pre_tokenize_str(lowered):
            word = lowered[a:b]
            if len(word) > 1 and word[0] == "'" and word[1].isalpha():
                # A contraction is a mark and letters until it is complete.
                out[a:b] = np.diff([0, *(self.by_library(word[:k]) for k in range(1, len(word) + 1))]).tolist()
            else:
                out[a:b] = self.piece(word)
        return out

    def piece(self, word: str) -> list[int]:
        """Differences for each code point of one lowered piece."""
        found = self.pieces.get(word)
        if found is None:
            found = self.count(word)
            if len(self.pieces) >= self.room:
                self.pieces.clear()
            if len(word) <= LONGEST_KEPT:
                self.pieces[word] = found
        return found

    def count(self, word: str) -> list[int]:
        """The dynamic programme over one piece.

        ``last`` and ``inner`` are the last token and the count of what begins the word, ``whole`` the count if the
        word ended there. A place has one last token, so every token that may follow fixes the place where it ends.
        """
        letters = word if word.isascii() and word.isprintable() else self.automaton.in_byte_letters(word)
        labels, arcs, has_arc, n = self.labels, self.automaton.arcs, self.automaton.has_arc, len(letters)
        last, inner, whole = [-1] * (n + 1), [0] * (n + 1), [0] * (n + 1)
        for p in range(n):
            state, count, end = last[p], inner[p] + 1, p
            while end < n:
                end += 1
                found = labels.get(letters[p:end])
                if found is None:
                    break
                inside, ending = found
                if inside >= 0 and not inner[end]:
                    follows = state < 0 or arcs.get(state << 17 | inside)
                    if has_arc(state, inside) if follows is None else follows:
                        last[end], inner[end] = inside, count
                if ending >= 0 and not whole[end]:
                    follows = state < 0 or arcs.get(state << 17 | ending)
                    if has_arc(state, ending) if follows is None else follows:
                        whole[end] = count
        if n != len(word):
            ends = np.cumsum([len(c.encode()) for c in word]).tolist()
            whole = [0, *(whole[e] for e in ends)]
        return [b - a for a, b in zip(whole, whole[1:], strict=False)]


def load_counter(path: str) -> PrefixCounter:
    with open(path, encoding="utf-8") as file:
        return PrefixCounter(load_automaton(path), file.read())


def differences(table: bytes) -> np.ndarray:
    return np.frombuffer(table, np.int8 if table[:1] == NARROW else "<i4", offset=1)


def counts(table: bytes) -> np.ndarray:
    """Tokens of every prefix, the empty one first."""
    return np.concatenate([[0], np.cumsum(differences(table), dtype=np.int64)])


def prefix_tables(docs: DataFrame, vocabulary: str) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, prefixes`` for every row; ``prefixes`` is the table of all prefixes of the text."""
    return counted(docs, vocabulary, True)


def token_counts(docs: DataFrame, vocabulary: str, limit: int = LIMIT) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` for every row, from the end of each table; tables stay in their tasks."""
    return counted(docs, vocabulary, False).select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))


def counted(docs: DataFrame, vocabulary: str, with_tables: bool) -> DataFrame:
    shared = Shared(docs.sparkSession, load_counter(vocabulary))

    def rows(batch: pa.RecordBatch) -> dict[str, object]:
        tables = list(map(shared.value.table, batch["text"].to_pylist()))
        totals = [int(differences(t).sum(dtype=np.int64)) for t in tables]
        columns = {"doc_id": batch["doc_id"], "n_bytes": batch["n_bytes"], "n_tokens": totals}
        return {**columns, "prefixes": tables} if with_tables else columns

    slim = docs.select("doc_id", F.octet_length(text_or_empty()).cast("bigint").alias("n_bytes"), text_or_empty().alias("text"))
    schema = "doc_id bigint, n_bytes bigint, n_tokens bigint" + ", prefixes binary" * with_tables
    return map_arrow(slim, schema, rows, 128)


def truncation_points(tables: DataFrame, budgets: Sequence[int]) -> DataFrame:
    """``doc_id, budget, n_chars, n_tokens``: for each row and budget the longest prefix with no more tokens than that.

    ``n_chars`` counts code points, so ``left(text, n_chars)`` is the truncated text. Reads ``prefixes`` only.
    """
    asked = np.array(sorted(set(budgets)), np.int64)
    if len(asked) and asked[0] < 0:
        raise ValueError("a budget is 0 or more")

    def rows(batch: pa.RecordBatch) -> dict[str, object]:
        cuts, tokens = [], []
        for table in batch["prefixes"].to_pylist():
            upto = counts(table)
            # The least count of this and all longer prefixes only grows, so the longest one that fits can be sought.
            least = np.minimum.accumulate(upto[::-1])[::-1]
            places = np.searchsorted(least, asked, "right") - 1
            cuts.append(places)
            tokens.append(upto[places])
        ids = batch["doc_id"].to_numpy(zero_copy_only=False)
        repeated = batch["doc_id"].take(pa.array(np.repeat(np.arange(len(ids)), len(asked))))
        return {"doc_id": repeated, "budget": np.tile(asked, len(ids)), "n_chars": np.concatenate(cuts), "n_tokens": np.concatenate(tokens)}

    return map_arrow(tables.select("doc_id", "prefixes"), "doc_id bigint, budget bigint, n_chars bigint, n_tokens bigint", rows, 128)


def tokens_of_prefix(tables: DataFrame, n_chars: Column) -> DataFrame:
    """``doc_id, n_chars, n_tokens``: the tokens of each row's prefix of so many code points, the whole text's beyond its end."""

    def rows(batch: pa.RecordBatch) -> dict[str, object]:
        asked = batch["n_chars"].to_pylist()
        found = [None if k is None else int(differences(t)[: max(k, 0)].sum(dtype=np.int64)) for t, k in zip(batch["prefixes"].to_pylist(), asked, strict=True)]
        return {"doc_id": batch["doc_id"], "n_chars": asked, "n_tokens": found}

    slim = tables.select("doc_id", n_chars.cast("bigint").alias("n_chars"), "prefixes")
    return map_arrow(slim, "doc_id bigint, n_chars bigint, n_tokens bigint", rows, 128)
