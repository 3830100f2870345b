"""Divergence audit of sources: how far each source's use of words lies from the others' of its language, and in which words.

Words are counted by sorting pointers. A shard is a slice of a task's Arrow buffers, laid out as one byte string in the
order of its (lang, source) groups; pointers to all word starts are sorted by multikey quicksort, eight bytes at a time:
a slice of pointers is parted into those whose next eight bytes are less than, equal to or greater than a pivot's, and
the equal ones go on with the following eight; small slices are sorted outright. All steps keep the order of equal
words, so a run of equal words lists its occurrences by group and by document, and its ends give occurrences and
document frequency for every group without a table of words. One row per word, group and shard goes on to Spark, which adds them up.

Smoothed shares are whole numbers and all arithmetic is exact: decimals in Spark, and 64-bit integers in tasks, which the shares
fit. The distance of every two sources is a sum over all kept terms of their language. Terms are dealt over ``SHARDS`` parts of a
language; a task goes through its terms with all sources beside each other and gives one partial sum for every two sources, so that no
pair of a term's sources is ever a row, and a common term weighs no more than another.

Defined results: a null ``lang``, ``source`` or text counts as empty. Texts of any length are read whole. Groups of texts without
words, and languages without kept terms, have distances of 0 and no terms. Ties go to the smaller item. Repeated rows count each. ``doc_id`` is not
read; an empty table gives no rows, and extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from metricloom.llm.common import text_or_empty
from metricloom.session import materialize

LEAST_DOCS = 10
TOP_TERMS = 10
SCALE = 1_000_000_000
SHARDS = 64

# A shard ends with the row that fills it.
SHARD_BYTES = 4 << 20
DIGIT = 8
# Slices up to this size are sorted outright.
SMALL = 1 << 13
PIVOT_SAMPLE = 9
# So many cells of terms by sources by sources are held at once.
CELLS = 1 << 21

# Only letters A to Z, lowered, and all bytes from 0x80 on belong to words; the rest becomes zero.
LETTERS = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 0 for b in range(256))


class WordPointers:
    """Pointers to the word starts of a byte string, in which words are kept apart by zeros."""

    def __init__(self, data: bytes):
        # A digit that begins at any byte can be read, and the last word ends.
        self.data = np.frombuffer(data + bytes(2 * DIGIT), np.uint8)
        inside = self.data != 0
        self.starts = np.flatnonzero(inside & ~np.concatenate([[False], inside[:-1]]))
        ends = np.flatnonzero(~inside & np.concatenate([[False], inside[:-1]]))
        self.lengths = ends - self.starts
        # Every eight bytes of the string as a number whose order is that of the bytes.
        self.digits = np.lib.stride_tricks.sliding_window_view(self.data, DIGIT)

    def digit(self, which: np.ndarray, depth: int) -> np.ndarray:
        """The eight bytes at ``depth`` digits into each word, zeros beyond its end."""
        raw = np.ascontiguousarray(self.digits[self.starts[which] + depth * DIGIT]).view(">u8").ravel().astype(np.uint64)
        over = DIGIT - np.clip(self.lengths[which] - depth * DIGIT, 0, DIGIT)
        # A word that ends inside the digit is followed by a zero and by what comes next in the text.
        cut = np.where(over < DIGIT, over, 0).astype(np.uint64) * np.uint64(8)
        return np.where(over < DIGIT, raw >> cut << cut, np.uint64(0))

    def sort(self) -> tuple[np.ndarray, np.ndarray]:
        """Word numbers in the order of their words, equal words in the order of the text; and whether each begins a run of equal words."""
        order = np.arange(len(self.starts))
        first = np.zeros(len(order), bool)
        pending = [(0, len(order), 0, self.digit(order, 0))] if len(order) else []
        while pending:
            a, b, depth, key = pending.pop()
            if b - a <= SMALL:
                self.finish(order, first, a, b, depth, key)
                continue
            pivot = np.sort(key[np.linspace(0, b - a - 1, PIVOT_SAMPLE).astype(np.int64)])[PIVOT_SAMPLE // 2]
            slice_, less, equal = order[a:b], key < pivot, key == pivot
            greater = ~(less | equal)
            parts = [(slice_[m], key[m]) for m in (less, equal, greater)]
            order[a:b] = np.concatenate([p for p, _ in parts])
            x, y = a + len(parts[0][0]), a + len(parts[0][0]) + len(parts[1][0])
            if x > a:
                pending.append((a, x, depth, parts[0][1]))
            if b > y:
                pending.append((y, b, depth, parts[2][1]))
            # A last byte of zero ends the word: its whole slice is one run.
            if int(pivot) & 0xFF:
                pending.append((x, y, depth + 1, self.digit(order[x:y], depth + 1)))
            else:
                first[x] = True
        return order, first

    def finish(self, order: np.ndarray, first: np.ndarray, a: int, b: int, depth: int, key: np.ndarray) -> None:
        """Sort a small slice whose words agree up to ``depth``: by one digit, then the runs of unfinished words by the next."""
        by_key = np.argsort(key, kind="stable")
        order[a:b], key = order[a:b][by_key], key[by_key]
        new = np.concatenate([[True], key[1:] != key[:-1]])
        open_ = np.flatnonzero(key & np.uint64(0xFF) != 0)
        while len(open_):
            depth += 1
            # Runs keep their places; only the order inside them is settled by the next digit.
            runs = np.cumsum(new)[open_]
            key = self.digit(order[a + open_], depth)
            by_key = np.lexsort((key, runs))
            order[a + open_], key = order[a + open_][by_key], key[by_key]
            change = np.concatenate([[True], (key[1:] != key[:-1]) | (runs[1:] != runs[:-1])])
            new[open_] |= change
            open_ = open_[key & np.uint64(0xFF) != 0]
        first[a:b] = new

    def word(self, which: int) -> str:
        at = self.starts[which]
        return self.data[at : at + self.lengths[which]].tobytes().decode("utf-8")


def shard_counts(langs: list[str], sources: list[str], texts: list[str]) -> pa.RecordBatch:
    """``lang, source, term, occurrences, docs`` of a shard: one row per word and group in it."""
    groups = sorted(set(zip(langs, sources, strict=True)))
    number = {g: i for i, g in enumerate(groups)}
    of_row = np.array([number[g] for g in zip(langs, sources, strict=True)])
    rows = np.argsort(of_row, kind="stable")
    parts = [texts[r].encode("utf-8").translate(LETTERS) for r in rows]
    pointers = WordPointers(b"\0".join(parts))
    order, first = pointers.sort()
    ends = np.cumsum([len(p) + 1 for p in parts])
    doc = np.searchsorted(ends, pointers.starts, "right")[order]
    group = of_row[rows][doc]
    # Runs are cut where the group changes, and within a run occurrences of one document stand together.
    begin = np.flatnonzero(first | np.concatenate([[True], group[1:] != group[:-1]])) if len(order) else np.zeros(0, np.int64)
    new_doc = np.concatenate([[True], doc[1:] != doc[:-1]])[: len(order)]
    new_doc[begin] = True
    sizes = np.diff([*begin.tolist(), len(order)])
    docs = np.add.reduceat(new_doc.astype(np.int64), begin) if len(begin) else sizes
    named = [groups[g] for g in group[begin].tolist()]
    return pa.record_batch(
        {
            "lang": pa.array([n[0] for n in named], pa.string()),
            "source": pa.array([n[1] for n in named], pa.string()),
            "term": pa.array([pointers.word(w) for w in order[begin].tolist()], pa.string()),
            "occurrences": pa.array(sizes, pa.int64()),
            "docs": pa.array(docs, pa.int64()),
        }
    )


def count_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``mapInArrow`` function over ``lang, source, text``; holds one shard at a time."""
    for batch in batches:
        held: tuple[list, list, list] = ([], [], [])
        size = 0
        for at in range(0, batch.num_rows, 64):
            part = batch.slice(at, 64)
            for lang, source, text in zip(*(part[c].to_pylist() for c in ("lang", "source", "text")), strict=True):
                for column, value in zip(held, (lang, source, text), strict=True):
                    column.append(value)
                size += len(text)
                if size >= SHARD_BYTES:
                    yield shard_counts(*held)
                    held, size = ([], [], []), 0
        if held[0]:
            yield shard_counts(*held)


def plain(docs: DataFrame) -> DataFrame:
    empty = F.lit("")
    return docs.select(F.coalesce("lang", empty).alias("lang"), F.coalesce("source", empty).alias("source"), text_or_empty().alias("text"))


def term_counts(docs: DataFrame) -> DataFrame:
    """``lang, source, term, occurrences, docs``: one row per term and group of the whole table."""
    per_shard = plain(docs).mapInArrow(count_shards, "lang string, source string, term string, occurrences bigint, docs bigint")
    return per_shard.groupBy("lang", "source", "term").agg(F.sum("occurrences").alias("occurrences"), F.sum("docs").alias("docs"))


def share(occurrences: Column, total: Column, terms: Column) -> Column:
    """``1 + floor(SCALE * (occurrences + 2) / (total + 2 * terms))``, in decimals that hold any 64-bit count."""
    wide = "decimal(28,0)"
    above = (occurrences.cast(wide) + 2) * F.lit(SCALE).cast("decimal(10,0)")
    return (F.call_function("div", above.cast("decimal(38,0)"), (total.cast(wide) + 2 * terms.cast("decimal(20,0)")).cast("decimal(38,0)")) + 1).cast("bigint")


def difference(p: Column, q: Column) -> Column:
    """``floor((p - q) ** 2 / (p + q))``; shares are at most ``SCALE + 1``, so the square fits 64 bits."""
    return F.call_function("div", (p - q) * (p - q), p + q)


def pair_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``mapInArrow`` function: rows of a part of a language, in the order ``lang, shard, term`` with the sources' own rows
    (null term) first; per part, the sum over its terms of the difference of every two sources."""
    lang: str | None = None
    shard = -1
    sources: dict[str, int] = {}
    unseen: list[int] = []
    total = np.zeros((0, 0), np.int64)
    block: np.ndarray | None = None
    filled, term = 0, None

    def flush() -> None:
        nonlocal filled
        shares = block[:filled]
        for i in range(len(sources)):
            mine = shares[:, i : i + 1]
            apart = shares - mine
            total[i] += (apart * apart // (shares + mine)).sum(axis=0)
        filled = 0

    def result() -> pa.RecordBatch:
        names, n = list(sources), len(sources)
        return pa.record_batch(
            {
                "lang": pa.array([lang] * (n * n), pa.string()),
                "source": pa.array(np.repeat(np.array(names, object), n), pa.string()),
                "item": pa.array(names * n, pa.string()),
                "value": pa.array(total.ravel()),
            }
        )

    for batch in batches:
        for row_lang, row_shard, row_term, source, p in zip(*(batch[c].to_pylist() for c in ("lang", "shard", "term", "source", "p")), strict=True):
            if (row_lang, row_shard) != (lang, shard):
                # A part without terms has no sums.
                if block is not None:
                    flush()
                    yield result()
                lang, shard, sources, unseen, block, term = row_lang, row_shard, {}, [], None, None
            if row_term is None:
                sources[source] = len(sources)
                unseen.append(p)
                continue
            if block is None:
                block = np.empty((max(1, CELLS // len(sources)), len(sources)), np.int64)
                total, filled = np.zeros((len(sources), len(sources)), np.int64), 0
            if row_term != term:
                if filled == len(block):
                    flush()
                block[filled] = unseen
                filled, term = filled + 1, row_term
            block[filled - 1, sources[source]] = p
    if block is not None:
        flush()
        yield result()


def audit(docs: DataFrame, least_docs: int = LEAST_DOCS, top_terms: int = TOP_TERMS) -> DataFrame:
    """``lang, source, part, item, value, rank`` for every (lang, source) group of ``docs``.

    Part ``pair``: the other sources of the language, those that differ most first. Part ``term``: the kept terms that the group uses
    more than its language, those that differ most first, ``top_terms`` at most.
    """
    counted = materialize(term_counts(docs), "divergence-counts")
    # A document has one group, so document frequencies of a language add up over its sources.
    kept = counted.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("occurrences").alias("in_lang")).where(F.col("docs") >= least_docs).drop("docs")
    terms = materialize(counted.drop("docs").join(kept, ["lang", "term"]), "divergence-terms")
    groups = plain(docs).select("lang", "source").distinct()
    sums = terms.groupBy("lang", "source").agg(F.sum("occurrences").alias("total"))
    of_lang = terms.select("lang", "term", "in_lang").distinct().groupBy("lang").agg(F.count(F.lit(1)).alias("kept"), F.sum("in_lang").alias("lang_total"))
    zero = F.lit(0).cast("bigint")
    sizes = materialize(
        groups.join(sums, ["lang", "source"], "left").join(of_lang, "lang", "left").select(
            "lang", "source", F.coalesce("total", zero).alias("total"), F.coalesce("kept", zero).alias("kept"), F.coalesce("lang_total", zero).alias("lang_total")
        ),
        "divergence-groups",
    )
    shares = materialize(
        terms.join(sizes, ["lang", "source"]).select(
            "lang",
            "source",
            "term",
            share(F.col("occurrences"), F.col("total"), F.col("kept")).alias("p"),
            share(F.col("in_lang"), F.col("lang_total"), F.col("kept")).alias("q"),
        ),
        "divergence-shares",
    )
    by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))
    rank = F.row_number().over(by_value)
    more = shares.where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), difference(F.col("p"), F.col("q")).alias("value"))
    best = more.withColumn("rank", rank).where(F.col("rank") <= top_terms)
    pairs = source_pairs(shares, sizes).withColumn("rank", rank)
    return pairs.unionByName(best).select("lang", "source", "part", "item", "value", "rank")


def source_pairs(shares: DataFrame, sizes: DataFrame) -> DataFrame:
    """``lang, source, part, item, value`` for every two sources of a language, in both directions."""
    shard = F.pmod(F.xxhash64("term"), F.lit(SHARDS)).cast("int")
    unseen = sizes.where("kept > 0").select(
        "lang", F.explode(F.sequence(F.lit(0), F.lit(SHARDS - 1))).alias("shard"), F.lit(None).cast("string").alias("term"), "source", share(F.lit(0), F.col("total"), F.col("kept")).alias("p")
    )
    rows = shares.select("lang", shard.alias("shard"), "term", "source", "p").unionByName(unseen)
    dealt = rows.repartition("lang", "shard").sortWithinPartitions("lang", "shard", F.asc_nulls_first("term"), "source")
    partial = dealt.select("lang", "shard", "term", "source", "p").mapInArrow(pair_sums, "lang string, source string, item string, value bigint")
    summed = partial.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    # All ordered pairs of a language are the result asked for, one row each.
    every = sizes.select("lang", "source").join(sizes.select("lang", F.col("source").alias("item")), "lang").where("source <> item")
    found = every.join(summed, ["lang", "source", "item"], "left")
    return found.select("lang", "source", F.lit("pair").alias("part"), "item", F.coalesce("value", F.lit(0).cast("bigint")).alias("value"))


SQL = """
WITH d AS (
  SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS words
  FROM documents),
w AS (SELECT row, lang, source, unnest(words) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS n FROM w GROUP BY lang, term HAVING count(DISTINCT row) >= 10),
counted AS (SELECT lang, source, term, count(*) AS n FROM w JOIN kept USING (lang, term) GROUP BY lang, source, term),
grouped AS (SELECT DISTINCT lang, source FROM d),
totals AS (
  SELECT lang, source, coalesce((SELECT sum(n) FROM counted c WHERE c.lang = g.lang AND c.source = g.source), 0) AS total,
    (SELECT count(*) FROM kept k WHERE k.lang = g.lang) AS v
  FROM grouped g),
of_lang AS (SELECT lang, sum(n) AS total, count(*) AS v FROM kept GROUP BY lang),
shares AS (
  SELECT t.lang, t.source, k.term, coalesce(c.n, 0) AS n,
    1 + 1000000000::HUGEINT * (coalesce(c.n, 0) + 2) // (t.total + 2 * t.v) AS p,
    1 + 1000000000::HUGEINT * (k.n + 2) // (l.total + 2 * l.v) AS q
  FROM totals t JOIN kept k ON k.lang = t.lang JOIN of_lang l ON l.lang = t.lang
  LEFT JOIN counted c ON c.lang = t.lang AND c.source = t.source AND c.term = k.term),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
found AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(p.value, 0) AS value
  FROM grouped a JOIN grouped b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, (p - q) * (p - q) // (p + q) FROM shares WHERE n > 0 AND p > q)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM found)
WHERE part = 'pair' OR rank <= 10
"""
