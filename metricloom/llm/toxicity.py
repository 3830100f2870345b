"""Toxicity: misspelled lexicon terms, weighed by their context.

The lexicon is learned: whole words and word beginnings that stand in toxic documents far more often than in
others. Levenshtein automata intersected with the lexicon's trie find them in a text, misspelled too: every term of
four letters or more has its edit bound, the first letter included. How much a misspelling tells is learned for each term and kind of
edit from how often documents that are not toxic come as near by chance. A window
of words around each hit tells abuse from quotation: quotation marks, verbs of saying and words about words
speak for quoting, words that address somebody for abuse. A logistic regression over the weighted hits of
each sort gives the score.

The lexicon and the regression are learned from a bounded sample, the ``MAX_ROWS`` labelled rows with the smallest
hash of their id.

Defined results: a null text counts as empty. Without rows of both labels every score is the share of toxic
ones among what there is, 0 without any. Repeated rows give repeated results; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Collection, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metricloom.llm.common import Shared, map_arrow, text_or_empty
from metricloom.llm.fuzzy import FuzzyLexicon, edits
from metricloom.llm.labelled import held_out, to_learn
from metricloom.session import materialize

MAX_ROWS = 20_000
MAX_TERMS = 2_000
# The share of a term's uses that is taken to be disguised in one way; labels may hold no disguised use to learn it from.
DISGUISED = 0.2
# Kinds of hits: as written, one letter changed inside, the first letter changed, several letters changed.
EXACT, INSIDE, FIRST, SEVERAL = range(4)
LEAST_Z = 3.0
LEAST_RATIO = 3.5
STEMS = range(4, 8)
LEXICON_SHARE = (3, 4)
WINDOW = 8
KEPT_WORDS = 400_000
RIDGE = 1e-2

WORD = re.compile(r"[^\W_]+")
QUOTES = re.compile("[\"“”„«»‹›]")
# Words of quoting and of address in English, German, French and Spanish.
SAYING = frozenset(
    "said says wrote called calls quoted quote quotes word words term slur phrase insult means meaning spelled "
    "sagte schrieb nannte wort begriff zitat bedeutet dit écrit appelé mot terme citation signifie "
    "dijo escribió llamó palabra término cita significa".split()
)
ADDRESS = frozenset("you your youre u ya du dich dir ihr euch tu toi vous te votre tú usted ustedes vosotros".split())
SORTS = ("word", "stem", "quoted", "addressed")
FEATURES = (*SORTS, "density", "length")


def terms(text: str) -> set[tuple[str, bool]]:
    """What a text could lend the lexicon: its words of three letters and more, and their beginnings; of words
    beyond forty letters the beginnings alone."""
    words = {w for w in WORD.findall(text.lower()) if len(w) >= 3 and not w.isdigit()}
    return {(w, False) for w in words if len(w) <= 40} | {(w[:n], True) for w in words for n in STEMS if len(w) > n}


def term_counts(sample: DataFrame) -> DataFrame:
    """``term, is_stem, toxic, other``: in how many documents of the sample each term stands. Tasks count before the shuffle."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 2048):
                part = batch.slice(start, 2048)
                counts: tuple[Counter, Counter] = (Counter(), Counter())
                for text, label in zip(part["text"].to_pylist(), part["label"].to_pylist(), strict=True):
                    counts[label].update(terms(text))
                keys = list(counts[0].keys() | counts[1].keys())
                yield pa.record_batch(
                    {
                        "term": pa.array([k[0] for k in keys], pa.string()),
                        "is_stem": pa.array([k[1] for k in keys], pa.bool_()),
                        "toxic": pa.array([counts[1][k] for k in keys], pa.int64()),
                        "other": pa.array([counts[0][k] for k in keys], pa.int64()),
                    }
                )

    partial = sample.select("text", "label").mapInArrow(count, "term string, is_stem boolean, toxic bigint, other bigint")
    return partial.groupBy("term", "is_stem").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))


@dataclass(frozen=True)
class Term:
    """A lexicon entry and the weights of its kinds of hits."""

    text: str
    is_stem: bool
    weights: tuple[float, float, float, float]


def hit_kind(word: str, term: str, spent: int) -> int:
    if spent == 0:
        return EXACT
    return SEVERAL if spent > 1 else FIRST if word[0] != term[0] else INSIDE


def chosen_terms(sample: DataFrame, sizes: dict[int, int]) -> list[tuple[str, bool, float, float, float]]:
    """The at most ``MAX_TERMS`` terms whose log odds ratio stands furthest above its standard error: text, whether a stem, that
    ratio, and the shares of toxic and of other documents that have it. A term is left out where a chosen one, shorter or longer,
    already covers its documents; whole words and longer beginnings go first."""
    a, b = F.col("toxic") + 0.5, F.col("other") + 0.5
    ratio = F.log(a / (sizes[1] - F.col("toxic") + 0.5)) - F.log(b / (sizes[0] - F.col("other") + 0.5))
    rated = term_counts(sample).where("toxic > 1").withColumn("ratio", ratio).withColumn("z", F.round(F.col("ratio") / F.sqrt(1 / a + 1 / b), 2))
    order = (F.col("z").desc(), "is_stem", F.length("term").desc(), "term")
    clear = rated.where((F.col("z") >= LEAST_Z) & (F.col("ratio") >= LEAST_RATIO))
    best = clear.orderBy(*order).limit(8 * MAX_TERMS).select("term", "is_stem", "ratio", "toxic", "other").collect()
    chosen: list[tuple[str, bool, float, float, float]] = []
    covered: dict[str, int] = {}
    stems: set[str] = set()
    for row in best:
        term, toxic = row["term"], row["toxic"]
        if len(chosen) == MAX_TERMS or any(term[:n] in stems for n in STEMS) or toxic < 1.1 * covered.get(term, 0):
            continue
        chosen.append((term, row["is_stem"], row["ratio"], toxic / sizes[1], row["other"] / sizes[0]))
        if row["is_stem"]:
            stems.add(term)
        for n in STEMS:
            covered[term[:n]] = max(covered.get(term[:n], 0), toxic)
    return chosen


def chance_counts(others: DataFrame, entries: list[tuple[str, bool, int]]) -> dict[tuple[int, int], int]:
    """In how many of the documents that are not toxic each entry is met by each kind of edit."""
    shared = Shared(others.sparkSession, entries)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon, known = FuzzyLexicon(shared.value), {}
        for batch in batches:
            counts: Counter = Counter()
            for text in batch["text"].to_pylist():
                met: set[tuple[int, int]] = set()
                for word in set(WORD.findall(text.lower())):
                    if word not in known:
                        if len(known) > KEPT_WORDS:
                            known.clear()
                        near = lexicon.matches(word)
                        known[word] = frozenset((e, hit_kind(word, entries[e][0], n)) for e, n in near.items() if n)
                    met |= known[word]
                counts.update(met)
            yield pa.record_batch(
                {
                    "entry": pa.array([k[0] for k in counts], pa.int32()),
                    "kind": pa.array([k[1] for k in counts], pa.int32()),
                    "met": pa.array(list(counts.values()), pa.int64()),
                }
            )

    partial = others.select("text").mapInArrow(count, "entry int, kind int, met bigint")
    return {(r["entry"], r["kind"]): r["met"] for r in partial.groupBy("entry", "kind").agg(F.sum("met").alias("met")).collect()}


def learn_lexicon(sample: DataFrame) -> list[Term]:
    """The chosen terms with the weights of their hits. As written, a hit weighs the log odds ratio. A near hit weighs the log of how much
    likelier it is in a toxic document, if ``DISGUISED`` of a term's uses look like that and chance brings as many more as it does to
    documents that are not toxic: where prose often comes near a term, its misspellings weigh next to nothing."""
    sizes = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
    if len(sizes) < 2:
        return []
    chosen = chosen_terms(sample, sizes)
    chance = chance_counts(sample.where("label = 0"), [(text, is_stem, edits(text)) for text, is_stem, *_ in chosen])
    found = []
    for number, (text, is_stem, ratio, toxic, other) in enumerate(chosen):
        weights = [ratio]
        for kind in (INSIDE, FIRST, SEVERAL):
            by_chance = (chance.get((number, kind), 0) + 0.5) / (sizes[0] + 1)
            near = math.log((by_chance + DISGUISED * toxic) / (by_chance + DISGUISED * other))
            weights.append(min(max(near, 0.0), ratio))
        found.append(Term(text, is_stem, tuple(weights)))
    return found


@dataclass
class Describer:
    """Turns a text into its features; remembers which words hit."""

    lexicon: list[Term]
    fuzzy: FuzzyLexicon = field(init=False)
    # The weightiest entry that a word meets, and its weight; None for other words.
    known: dict[str, tuple[int, float] | None] = field(init=False, default_factory=dict)

    def __post_init__(self) -> None:
        self.fuzzy = FuzzyLexicon((t.text, t.is_stem, edits(t.text)) for t in self.lexicon)

    def __reduce__(self) -> tuple:
        return Describer, (self.lexicon,)

    def hit(self, word: str) -> tuple[int, float] | None:
        near = self.fuzzy.matches(word)
        rated = [(self.lexicon[e].weights[hit_kind(word, self.lexicon[e].text, n)], -n, -e) for e, n in near.items()]
        weight, _, entry = max(rated, default=(0.0, 0, 0))
        return (-entry, weight) if weight > 0 else None

    def hits(self, words: set[str]) -> dict[str, tuple[int, float]]:
        if len(self.known) > KEPT_WORDS:
            self.known = {}
        found = {}
        for word in words:
            if word not in self.known:
                self.known[word] = self.hit(word)
            if self.known[word] is not None:
                found[word] = self.known[word]
        return found

    def features(self, text: str) -> list[float]:
        low = text.lower()
        words = WORD.findall(low)
        hits = self.hits(set(words))
        sums = dict.fromkeys(SORTS, 0.0)
        count = 0.0
        if hits:
            for place, start, end in self.places(low, hits.keys()):
                entry, weight = hits[words[place]]
                term = self.lexicon[entry]
                near = words[max(0, place - WINDOW) : place + WINDOW + 1]
                if self.quoted(low, start, end) or not SAYING.isdisjoint(near):
                    sums["quoted"] += weight
                    continue
                count += weight / term.weights[EXACT]
                sums["stem" if term.is_stem else "word"] += weight
                if not ADDRESS.isdisjoint(near):
                    sums["addressed"] += weight
        return [*(float(np.log1p(v)) for v in sums.values()), float(np.log1p(1000 * count / max(len(words), 1))), float(np.log1p(len(words))) / 10]

    @staticmethod
    def places(text: str, matched: Collection[str]) -> Iterator[tuple[int, int, int]]:
        """Word number, start and end of each hit in a lowered text."""
        for place, match in enumerate(WORD.finditer(text)):
            if match[0] in matched:
                yield place, *match.span()

    @staticmethod
    def quoted(text: str, start: int, end: int) -> bool:
        """Whether a quotation mark stands on either side within the line and a window's breadth of letters."""
        before = text[max(0, start - 12 * WINDOW) : start].rpartition("\n")[2]
        after = text[end : end + 12 * WINDOW].partition("\n")[0]
        return len(QUOTES.findall(before)) % 2 == 1 and QUOTES.search(after) is not None


def fit_logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Ridge logistic regression by Newton's method; the last coefficient is the intercept."""
    x = np.column_stack([x, np.ones(len(x))])
    penalty = np.full(x.shape[1], RIDGE)
    penalty[-1] = 1e-6
    beta = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        gradient = x.T @ (y - p) / len(y) - penalty * beta
        hessian = (x * (p * (1 - p))[:, None]).T @ x / len(y) + np.diag(penalty) + 1e-9 * np.eye(x.shape[1])
        step = np.linalg.solve(hessian, gradient)
        beta += step
        if np.abs(step).max() < 1e-8:
            break
    return beta


def described(docs: DataFrame, describer: Describer, *extra: str) -> DataFrame:
    """``doc_id, x`` and the columns named, per row of ``doc_id, text``."""
    shared = Shared(docs.sparkSession, describer)

    def rows(batch: pa.RecordBatch) -> dict[str, object]:
        return {**{c: batch[c] for c in ("doc_id", *extra)}, "x": [shared.value.features(t) for t in batch["text"].to_pylist()]}

    kinds = dict(docs.dtypes)
    schema = ", ".join(f"{c} {kinds[c]}" for c in ("doc_id", *extra)) + ", x array<double>"
    return map_arrow(docs.select("doc_id", "text", *extra), schema, rows)


def train(docs: DataFrame, labels: DataFrame) -> tuple[Describer, np.ndarray | float]:
    """The lexicon and the coefficients, or a constant score where there is nothing to learn from."""
    known = to_learn(labels, "toxic").orderBy(F.xxhash64("doc_id"), "doc_id").limit(MAX_ROWS)
    texts = docs.select("doc_id", text_or_empty().alias("text"))
    sample = materialize(texts.join(materialize(known, "toxicity-labels"), "doc_id"), "toxicity-sample")
    # The regression sees rows that the lexicon has not, so that it learns what a chance term is worth.
    for_lexicon = F.pmod(F.xxhash64("doc_id", F.lit(1)), LEXICON_SHARE[1]) < LEXICON_SHARE[0]
    describer = Describer(learn_lexicon(sample.where(for_lexicon)))
    rows = described(sample.where(~for_lexicon), describer, "label").select("x", "label").collect()
    y = np.array([r["label"] for r in rows], np.float64)
    if not len(y) or y.min() == y.max():
        return describer, float(y.mean()) if len(y) else 0.0
    return describer, fit_logistic(np.array([r["x"] for r in rows]), y)


def toxicity_scores(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``docs``."""
    scored = score_rows(docs.select("doc_id", text_or_empty().alias("text")), labels)
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def score_rows(texts: DataFrame, labels: DataFrame, *extra: str) -> DataFrame:
    """``doc_id, score`` and the columns named, per row."""
    describer, model = train(texts, labels)
    x = described(texts, describer, *extra)
    if isinstance(model, float):
        return x.drop("x").withColumn("score", F.lit(model))
    logit = sum((F.col("x")[i] * float(c) for i, c in enumerate(model[:-1])), F.lit(float(model[-1])))
    return x.withColumn("score", 1 / (1 + F.exp(-logit))).drop("x")


def without_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` whose score stays below the threshold, with all their columns."""
    keyed = docs.select("doc_id", text_or_empty().alias("text"), F.xxhash64(text_or_empty()).alias("text_hash"))
    toxic = score_rows(keyed, labels, "text_hash").where(F.col("score") >= threshold).select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__h"))
    toxic = materialize(toxic.distinct(), "toxicity-rejected")
    same = docs["doc_id"].eqNullSafe(toxic["__id"]) & (F.xxhash64(F.coalesce(docs["text"], F.lit(""))) == toxic["__h"])
    return docs.join(toxic, same, "left_anti")
