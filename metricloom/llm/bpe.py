"""BPE encoding and decoding by a tokenization automaton.

The automaton reads tokens; its state is the token read last. It accepts exactly the token sequences
that BPE can produce. It starts with one state over the single symbols and grows by one gadget per
merge (u, v) -> w, in the order of the merges:

* after u, the arc v is removed;
* the arc w is added to every state that still has the arc u, so w falls back on u's removals so far;
* the state of w is the state of v as it was before this merge, so it falls back on v's removals so far.

The fallbacks are stored as links with the number of the merge up to which they hold, not as copies, so
the tables are as small as the vocabulary. A word has a single accepted path, which a longest-first walk
finds; the results of arcs and words are kept in bounded tables. Decoding emits the labels of the arcs.

Defined results: a null or empty text has no tokens. The two special strings of the vocabulary are
matched wherever they stand in a text. Repeated rows give repeated results; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from metricloom.llm.common import Shared, map_arrow, text_or_empty

# Fixed values of the vocabulary's file format.
WORD_END = "</w>"
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
# Below this letter nothing composes, and letters are lowered one by one.
NO_MARKS_BELOW = "\u0250"
NO_LIMIT = 1 << 40
END_MARKS = frozenset(".,;:!?")
LONGEST_KEPT = 64
# So many letters of a label look up the longest label that begins with them.
FIRST = 4


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte: printable Latin-1 for itself, the rest from U+0100 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = iter(range(0x100, 0x200))
    return [chr(b) if b in printable else chr(next(others)) for b in range(256)]


def plain_word(chunk: str) -> tuple[str, str] | None:
    """What most chunks are: a word of Latin letters, lowered, and perhaps one mark at its end."""
    if chunk.isalpha():
        word, mark = chunk, ""
    elif chunk[-1:] in END_MARKS and chunk[:-1].isalpha():
        word, mark = chunk[:-1], chunk[-1]
    else:
        return None
    word = word.lower()
    return (word, mark) if word.isascii() or max(word) < NO_MARKS_BELOW else None


class Chunks(dict[str, bytes]):
    """Ids of chunks met so far; a new chunk is encoded when it is asked for, and kept while there is room."""

    def __init__(self, encoder: WordEncoder):
        super().__init__()
        self.encoder = encoder

    def __missing__(self, chunk: str) -> bytes:
        ids = self.encoder.encode_chunk(chunk)
        if len(self) < self.encoder.kept and len(chunk) <= LONGEST_KEPT:
            self[chunk] = ids
        return ids


class WordEncoder:
    """Splits text into words as a vocabulary file says and remembers their ids; ``kept`` bounds the numbers of
    chunks and words remembered. How a word is encoded is up to the subclass.

    ``splitting`` holds the file's rules for normalising and splitting text; chunks beyond Latin letters are split
    by the library with them, so that both agree on the classes of all letters.
    """

    UNSHIPPED = ("words", "chunks", "letters", "find_pieces", "special_split", "rules")

    def __init__(self, special: dict[str, int], splitting: dict[str, object], kept: int = 400_000):
        self.special, self.splitting, self.kept = special, splitting, kept
        self.ready()

    def ready(self) -> None:
        """What is not shipped: the tables of results and the compiled patterns."""
        self.words: dict[str, bytes] = {}
        self.chunks = Chunks(self)
        self.letters = str.maketrans(dict(enumerate(byte_letters())))
        self.find_pieces = regex.compile(PIECES).findall
        self.special_split = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        bare = {"version": "1.0", "added_tokens": [], "model": {"type": "BPE", "vocab": {}, "merges": []}}
        self.rules = Tokenizer.from_str(json.dumps({**bare, **self.splitting}))

    def __getstate__(self) -> dict[str, object]:
        return {k: v for k, v in self.__dict__.items() if k not in self.UNSHIPPED}

    def __setstate__(self, state: dict[str, object]) -> None:
        self.__dict__.update(state)
        self.ready()

    def encode_word(self, word: str) -> list[int]:
        """Ids of a word in byte letters."""
        raise NotImplementedError

    def pieces(self, text: str) -> list[str]:
        """Normalised pieces in byte letters."""
        lowered = text.lower()
        if lowered.isascii() or max(lowered) < NO_MARKS_BELOW:
            return [self.in_byte_letters(p) for p in self.find_pieces(lowered)]
        return [p for p, _ in self.rules.pre_tokenizer.pre_tokenize_str(self.rules.normalizer.normalize_str(text))]

    def word_ids(self, word: str) -> bytes:
        """Ids of one lowered piece of Latin letters or marks."""
        ids = self.words.get(word)
        if ids is None:
            if len(self.words) >= self.kept:
                self.words.clear()
            ids = self.words[word] = self.piece_ids(word if word.isascii() else self.in_byte_letters(word))
        return ids

    def piece_ids(self, piece: str) -> bytes:
        return array("H", self.encode_word(piece)).tobytes()

    def in_byte_letters(self, piece: str) -> str:
        return piece.encode().decode("latin-1").translate(self.letters)

    def encode_chunk(self, chunk: str) -> bytes:
        plain = plain_word(chunk)
        if plain is not None:
            return self.word_ids(plain[0]) + (self.word_ids(plain[1]) if plain[1] else b"")
        out = b""
        for part in self.special_split.split(chunk) if "<|" in chunk and self.special_split else (chunk,):
            if part in self.special:
                out += array("H", (self.special[part],)).tobytes()
            else:
                out += b"".join(self.piece_ids(p) for p in self.pieces(part))
        return out

    def encode_bytes(self, text: str) -> bytes:
        """Token ids of a text as 16-bit numbers. No piece crosses a blank, so each chunk between blanks is
        encoded by itself."""
        if len(self.chunks) >= self.kept:
            self.chunks.clear()
        return b"".join(map(self.chunks.__getitem__, text.replace("\n", " ").split(" ")))

    def encode(self, text: str) -> list[int]:
        return array("H", self.encode_bytes(text)).tolist()


class Automaton(WordEncoder):
    """Tables compiled from the merges."""

    UNSHIPPED = (*WordEncoder.UNSHIPPED, "arcs", "decimals")

    def __init__(
        self,
        vocabulary: dict[str, int],
        merges: Iterable[tuple[str, str]],
        special: dict[str, int],
        splitting: dict[str, object],
        kept: int = 400_000,
    ):
        self.labels = [""] * (1 + max([*vocabulary.values(), *special.values()]))
        for label, i in [*vocabulary.items(), *special.items()]:
            self.labels[i] = label
        self.removed: dict[int, int] = {}
        # For a merged token: the token it falls back on, and the merge up to which that holds.
        self.arc_fallback: dict[int, tuple[int, int]] = {}
        self.state_fallback: dict[int, tuple[int, int]] = {}
        for rank, (left, right) in enumerate(merges):
            self.add_gadget(rank, vocabulary[left], vocabulary[right], vocabulary[left + right])
        # Arcs inside a word and arcs that end it, by label; what the merges never produce has none.
        self.inner: dict[str, int] = {}
        self.final: dict[str, int] = {}
        self.reach: dict[str, int] = {}
        for label, i in vocabulary.items():
            bare = label.removesuffix(WORD_END)
            if i in self.arc_fallback or len(bare) == 1:
                (self.inner if bare == label else self.final)[bare] = i
                if len(bare) >= FIRST:
                    self.reach[bare[:FIRST]] = max(self.reach.get(bare[:FIRST], 0), len(bare))
        super().__init__(special, splitting, kept)

    def ready(self) -> None:
        super().ready()
        self.arcs: dict[int, bool] = {}
        self.decimals = [str(i) for i in range(len(self.labels))]

    def add_gadget(self, rank: int, left: int, right: int, merged: int) -> None:
        self.removed.setdefault(left << 17 | right, rank)
        if merged not in self.arc_fallback:
            self.arc_fallback[merged] = (left, rank)
            self.state_fallback[merged] = (right, rank)

    def has_arc(self, state: int, token: int) -> bool:
        """Whether ``token`` can follow ``state``: no removal on either chain of fallbacks holds."""
        allowed, s, s_limit = True, state, NO_LIMIT
        while allowed:
            t, t_limit = token, NO_LIMIT
            while True:
                rank = self.removed.get(s << 17 | t)
                # A state copies what came before its own merge; an arc also what that merge removed.
                if rank is not None and rank < s_limit and rank <= t_limit:
                    allowed = False
                    break
                if t not in self.arc_fallback:
                    break
                t, t_limit = self.arc_fallback[t]
            if s not in self.state_fallback:
                break
            s, s_limit = self.state_fallback[s]
        if len(self.arcs) >= self.kept:
            self.arcs.clear()
        self.arcs[state << 17 | token] = allowed
        return allowed

    def encode_word(self, word: str) -> list[int]:
        """The accepted path over ``word``, given in byte letters; longest arcs first, dead ends remembered."""
        whole = self.final.get(word)
        if whole is not None:
            return [whole]
        inner, final, arcs, reach, n = self.inner, self.final, self.arcs, self.reach, len(word)
        path: list[int] = []
        starts: list[int] = []
        dead: set[tuple[int, int]] = set()
        at, size = 0, reach.get(word[:FIRST], FIRST - 1)
        while at < n:
            state = path[-1] if path else -1
            size = min(size, n - at)
            while size:
                token = final.get(word[at:]) if at + size == n else inner.get(word[at : at + size])
                if token is not None and (not dead or (at + size, token) not in dead):
                    if state < 0:
                        break
                    follows = arcs.get(state << 17 | token)
                    if self.has_arc(state, token) if follows is None else follows:
                        break
                size -= 1
            if size:
                path.append(token)
                starts.append(at)
                at += size
                size = reach.get(word[at : at + FIRST], FIRST - 1)
            else:
                dead.add((at, path.pop()))
                size = at - starts[-1] - 1
                at = starts.pop()
        return path

    def decode(self, ids: Iterable[int]) -> str:
        """The labels of the arcs, set apart by blanks, as this vocabulary's files without a decoder ask for."""
        return " ".join(map(self.labels.__getitem__, ids))

    def in_decimal(self, ids: Iterable[int]) -> str:
        return " ".join(map(self.decimals.__getitem__, ids))


def rules_of(read: dict) -> tuple[dict[str, int], dict[str, object]]:
    """A vocabulary file's special strings and its rules for normalising and splitting."""
    return {t["content"]: t["id"] for t in read["added_tokens"]}, {k: read[k] for k in ("normalizer", "pre_tokenizer")}


def load_automaton(path: str) -> Automaton:
    with open(path, encoding="utf-8") as file:
        read = json.load(file)
    special, splitting = rules_of(read)
    pairs = (tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in read["model"]["merges"])
    return Automaton(read["model"]["vocab"], pairs, special, splitting)


def encode_documents(docs: DataFrame, vocabulary: str) -> DataFrame:
    """``doc_id, n_tokens, ids`` for every row; ``ids`` is an array of ints.

    The compiled tables are broadcast; the vocabulary file bounds their size (some 3 MB).
    """
    shared = Shared(docs.sparkSession, load_automaton(vocabulary))

    def rows(batch: pa.RecordBatch) -> dict[str, object]:
        found = [np.frombuffer(shared.value.encode_bytes(t), np.uint16) for t in batch["text"].to_pylist()]
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
        ids = pa.ListArray.from_arrays(offsets, np.concatenate(found).astype(np.int32))
        return {"doc_id": batch["doc_id"], "n_tokens": sizes, "ids": ids}

    return map_arrow(docs.select("doc_id", text_or_empty().alias("text")), "doc_id bigint, n_tokens bigint, ids array<int>", rows, 128)


def encode_and_decode(docs: DataFrame, vocabulary: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` for every row, encoded and decoded in one pass."""
    shared = Shared(docs.sparkSession, load_automaton(vocabulary))

    def digest(text: str) -> str:
        return hashlib.sha256(text.encode("utf-8")).hexdigest()

    def rows(batch: pa.RecordBatch) -> dict[str, object]:
        automaton = shared.value
        counts, ids_digests, text_digests = [], [], []
        for text in batch["text"].to_pylist():
            ids = automaton.encode(text)
            counts.append(len(ids))
            ids_digests.append(digest(automaton.in_decimal(ids)))
            text_digests.append(digest(automaton.decode(ids)))
        return {"doc_id": batch["doc_id"], "n_tokens": counts, "ids_sha256": ids_digests, "decoded_sha256": text_digests}

    schema = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return map_arrow(docs.select("doc_id", text_or_empty().alias("text")), schema, rows, 128)


def words_of(ids: Iterable[int], labels: list[str]) -> Iterator[str]:
    """The words of a token sequence as plain text."""
    back = {letter: bytes([b]) for b, letter in enumerate(byte_letters())}
    word = b""
    for i in ids:
        label = labels[i]
        end = label.endswith(WORD_END)
        word += b"".join(back.get(c, c.encode()) for c in label.removesuffix(WORD_END))
        if end:
            yield word.decode("utf-8", "replace")
            word = b""
    if word:
        yield word.decode("utf-8", "replace")
