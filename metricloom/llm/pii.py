"""Personal data, also where it is disguised, with the spans of the source text.

Base spans are the matches of four fixed patterns. For what is disguised, a chain of transducers rewrites the
text: homoglyphs become ASCII and invisible letters go; runs of spelled digits become digits; disguised "at"
and "dot" become "@" and ".". Each carries along where every letter came from, so a match in the rewritten text
is reported by its place in the source. A match counts only if it holds something rewritten and touches no
base span of its kind. A bare "at" counts only where the dots after it are spelled too, as prose is full of it.

Defined results: a null or empty text has no spans. Repeated rows give repeated results; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
import sys
import unicodedata
from bisect import bisect_left
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from metricloom.llm.common import map_arrow, text_or_empty

KINDS = ("email", "ip", "card", "phone")
Span = tuple[int, int]

LOCAL_PART = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A run of digits that begins no match is passed over whole, as no later start in it would match either.
IP = re.compile(r"([0-9]++(?:\.[0-9]++){3})|[0-9]++")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")


def emails(text: str) -> Iterator[Span]:
    """Found from each "@" outwards: to the left all letters of the local part down to the last match."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL_PART:
            start -= 1
        match = DOMAIN.match(text, at + 1) if start < at else None
        if match:
            yield start, match.end()
            done = match.end()
        at = text.find("@", max(at + 1, done))


def ips(text: str) -> Iterator[Span]:
    for match in IP.finditer(text):
        if match[1] and all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or "0") <= 255 for part in match[0].split(".")):
            yield match.span()


def luhn(digits: str) -> bool:
    doubled = (int(d) * 2 for d in digits[-2::-2])
    return (sum(int(d) for d in digits[-1::-2]) + sum(d - 9 if d > 9 else d for d in doubled)) % 10 == 0


def cards(text: str) -> Iterator[Span]:
    for match in CARD.finditer(text):
        digits = match[0].replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and luhn(digits):
            yield match.span()


def phones(text: str) -> Iterator[Span]:
    for match in PHONE.finditer(text):
        if 8 <= sum(c in "0123456789" for c in match[0]) <= 15:
            yield match.span()


DETECTORS: dict[str, Callable[[str], Iterator[Span]]] = dict(zip(KINDS, (emails, ips, cards, phones), strict=True))


# Letters of other alphabets that look like Latin ones, in two rows of equal length.
LOOKALIKES = str.maketrans(
    "АВЕЅІЈКМНОРСТУХаеорсухѕіјһԁԛԝΑΒΕΖΗΙΚΜΝΟΡΤΥΧοιανⲟօ",
    "ABESIJKMHOPCTYXaeopcyxsijhdqwABEZHIKMNOPTYXoiavoo",
)
INVISIBLE = "­​‌‍⁠﻿"
DASHES = "‐‑‒–—−"
DOTS = "。․｡·∙"
# The digits from 0 to 9 in English, German, French and Spanish, and further words for them.
DIGIT_WORDS = (
    "zero one two three four five six seven eight nine",
    "null eins zwei drei vier fünf sechs sieben acht neun",
    "zéro un deux trois quatre cinq six sept huit neuf",
    "cero uno dos tres cuatro cinco seis siete ocho nueve",
)
DIGIT_OF = {word: str(d) for row in DIGIT_WORDS for d, word in enumerate(row.split())} | {"oh": "0"}
# Words for the signs, in the same languages.
AT_WORDS = ("at", "ät", "arobase", "arroba", "@")
DOT_WORDS = ("dot", "punkt", "point", "punto", ".")
PLUS_WORDS = ("plus", "más", "mas")


def homoglyphs() -> dict[int, str]:
    """Every letter beyond ASCII that stands for one of ASCII: by compatibility, as a digit, or by its looks."""
    table = dict(LOOKALIKES)
    table = {k: chr(v) if isinstance(v, int) else v for k, v in table.items()}
    for code in range(0x80, sys.maxunicode + 1):
        letter = chr(code)
        kind = unicodedata.category(letter)
        if kind == "Nd":
            table[code] = str(unicodedata.digit(letter))
        elif kind not in ("Cs", "Cn", "Co") and "<super>" not in (form := unicodedata.decomposition(letter)) and form.startswith("<"):
            plain = unicodedata.normalize("NFKC", letter)
            if len(plain) == 1 and " " <= plain <= "~":
                table[code] = plain
    table |= dict.fromkeys(map(ord, INVISIBLE), "") | dict.fromkeys(map(ord, DASHES), "-") | dict.fromkeys(map(ord, DOTS), ".")
    return table


class Tape:
    """A rewritten text. ``starts`` and ``ends`` give each letter's place in the source; ``changed`` the places
    of letters that were rewritten, ascending, and ``bare`` those of a bare "at"."""

    def __init__(self, text: str):
        self.text = text
        self.starts: list[int] | range = range(len(text))
        self.ends: list[int] | range = range(1, len(text) + 1)
        self.changed: list[int] = []
        self.bare: list[int] = []

    def rewrite(self, pattern: re.Pattern[str], emit: Callable[[re.Match[str]], str | None], is_bare: Callable[[re.Match[str]], bool] = lambda m: False) -> None:
        """Run a transducer: ``emit`` gives what takes a match's place, or None to leave it."""
        text, old_changed, old_bare = self.text, set(self.changed), set(self.bare)
        parts: list[str] = []
        starts: list[int] = []
        ends: list[int] = []
        changed: list[int] = []
        bare: list[int] = []
        at = 0

        def copy(upto: int) -> None:
            if old_changed or old_bare:
                base = len(starts) - at
                changed.extend(base + i for i in range(at, upto) if i in old_changed)
                bare.extend(base + i for i in range(at, upto) if i in old_bare)
            parts.append(text[at:upto])
            starts.extend(self.starts[at:upto])
            ends.extend(self.ends[at:upto])

        for match in pattern.finditer(text):
            new = emit(match)
            if new is None:
                continue
            copy(match.start())
            at = match.end()
            # What is taken out shows in the letters on either side.
            changed.extend(range(len(starts), len(starts) + len(new)) if new else (max(len(starts) - 1, 0), len(starts)))
            if is_bare(match):
                bare.extend(range(len(starts), len(starts) + len(new)))
            parts.append(new)
            starts.extend([self.starts[match.start()]] * len(new))
            ends.extend([self.ends[match.end() - 1]] * len(new))
        if at:
            copy(len(text))
            self.text, self.starts, self.ends, self.changed, self.bare = "".join(parts), starts, ends, changed, bare


def any_of(words: tuple[str, ...] | list[str]) -> str:
    return "|".join(map(re.escape, sorted(words, key=len, reverse=True)))


class Finder:
    """The compiled patterns of the transducers."""

    def __init__(self) -> None:
        self.table = homoglyphs()
        self.odd_letters = frozenset(map(chr, self.table))
        self.odd_latin = tuple(c for c in self.odd_letters if c <= "\xff")
        self.odd = re.compile("[" + "".join(map(re.escape, map(chr, self.table))) + "]")
        digit = any_of([*DIGIT_OF])
        run = rf"(?:{digit})(?:[ -](?:{digit}))*"
        self.digits = re.compile(rf"\b(?:{run})\b", re.IGNORECASE)
        self.digit_word = re.compile(digit, re.IGNORECASE)
        self.plus = re.compile(rf"(?:\b(?:{any_of(PLUS_WORDS)})[ -]?|[\[(]\+[\])] ?)(?=[0-9(])", re.IGNORECASE)
        signs = any_of([*AT_WORDS, *DOT_WORDS])
        self.bracketed = re.compile(rf" ?[\[({{<] ?({signs}) ?[\])}}>] ?", re.IGNORECASE)
        self.spelled = re.compile(rf"(?<=[A-Za-z0-9]) ({any_of([*AT_WORDS[:-1], *DOT_WORDS[:-1]])}) (?=[A-Za-z0-9])|(?<=[A-Za-z0-9])[_-](at|dot)[_-](?=[A-Za-z0-9])", re.IGNORECASE)

    def has_odd(self, text: str) -> bool:
        """Whether the first transducer would rewrite anything."""
        if text.isascii():
            return False
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return not self.odd_letters.isdisjoint(text)
        return any(c in text for c in self.odd_latin)

    def digit_of(self, word: str) -> str:
        # Patterns that ignore case take these two letters for "i", which lower() does not.
        return DIGIT_OF[word.replace("İ", "i").replace("ı", "i").lower()]

    def normalised(self, text: str) -> Tape:
        tape = Tape(text)
        if self.has_odd(text):
            tape.rewrite(self.odd, lambda m: self.table[ord(m[0])])
        tape.rewrite(self.digits, lambda m: "".join(self.digit_of(w) for w in self.digit_word.findall(m[0])))
        tape.rewrite(self.plus, lambda m: "+")
        sign = lambda m: "@" if (m[1] or m[2]).lower() in AT_WORDS else "."
        tape.rewrite(self.bracketed, lambda m: "@" if m[1].lower() in AT_WORDS else ".")
        tape.rewrite(self.spelled, sign, lambda m: sign(m) == "@")
        return tape

    def added(self, text: str, base: dict[str, list[Span]]) -> dict[str, list[Span]]:
        """Spans that only the rewritten text shows."""
        tape = self.normalised(text)
        found: dict[str, list[Span]] = {kind: [] for kind in KINDS}
        if not tape.changed:
            return found
        bare, changed = set(tape.bare), tape.changed
        for kind, detect in DETECTORS.items():
            for start, end in detect(tape.text):
                first = bisect_left(changed, start)
                if first == len(changed) or changed[first] >= end:
                    continue
                at = tape.text.find("@", start, end)
                if kind == "email" and at in bare and not all(changed[bisect_left(changed, i) % len(changed)] == i for i in range(at, end) if tape.text[i] == "."):
                    continue
                span = (tape.starts[start], tape.ends[end - 1])
                place = bisect_left(base[kind], (span[1],))
                if place and base[kind][place - 1][1] > span[0]:
                    continue
                found[kind].append(span)
        return found

    def spans(self, text: str) -> tuple[dict[str, list[Span]], dict[str, list[Span]]]:
        """Base spans and added spans by kind, each ascending."""
        base = {kind: list(detect(text)) for kind, detect in DETECTORS.items()}
        return base, self.added(text, base)


def listed(spans: dict[str, list[Span]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind in KINDS for start, end in spans[kind])


def find_personal_data(docs: DataFrame) -> DataFrame:
    """``doc_id, kinds, base, added`` lists: per row an array of ``kind, start, end, added`` structs."""
    made: list[Finder] = []

    def rows(batch: pa.RecordBatch) -> dict[str, object]:
        if not made:
            made.append(Finder())
        out = []
        for text in batch["text"].to_pylist():
            both = made[0].spans(text)
            out.append([{"kind": k, "start": s, "end": e, "added": bool(i)} for i in (0, 1) for k in KINDS for s, e in both[i][k]])
        return {"doc_id": batch["doc_id"], "found": out}

    schema = "doc_id bigint, found array<struct<kind:string,start:bigint,end:bigint,added:boolean>>"
    return map_arrow(docs.select("doc_id", text_or_empty().alias("text")), schema, rows)


def span_digests(docs: DataFrame) -> DataFrame:
    """``doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans``; the counts are those of the base spans."""
    made: list[Finder] = []

    def rows(batch: pa.RecordBatch) -> dict[str, object]:
        if not made:
            made.append(Finder())
        out: dict[str, list] = {name: [] for name in ("n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans")}
        for text in batch["text"].to_pylist():
            base, added = made[0].spans(text)
            for kind in KINDS:
                out[f"n_{kind}"].append(len(base[kind]))
            out["base_sha256"].append(hashlib.sha256(listed(base).encode()).hexdigest())
            out["spans"].append(listed({kind: sorted(base[kind] + added[kind]) for kind in KINDS}))
        return {"doc_id": batch["doc_id"], **out}

    schema = "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string"
    return map_arrow(docs.select("doc_id", text_or_empty().alias("text")), schema, rows)
