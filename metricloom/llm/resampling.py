"""Importance resampling towards a target distribution, over hashed word n-grams.

Features come from an overlapped regular-expression scan. Letters are lowered and separators become single
spaces; then, for each length k, a pattern of k words between boundary lookarounds is run over the UTF-8 bytes with
``overlapped=True``, so that a match begins at every word and its span is the n-gram itself, ready for the CRC that
names its bucket. No list of words is built and nothing is joined again.

Texts are scanned once: buckets are written as 16- or 32-bit numbers, and both the counts over all documents and each
document's weight come from there. Counts are added up in each task before they are shuffled. The driver holds one number
per bucket, and the tasks get those of the gains; ``BUCKETS`` bounds both.

The draw is exact at any size without a sort of all documents: a histogram over bins of scores tells which bin
the last drawn document falls in, documents from that bin on are sorted by range over many tasks, and places in a task
plus the sizes of the tasks before it are the ranks.

Defined results: a null text has no features and weight 0. Texts of any length are read whole. A null ``doc_id`` counts as empty text in
the draw's hash and comes after all others among ties; rows with equal score and ``doc_id`` follow the order in which they were read and written
down, each with a rank of its own. Without documents, or without benchmark texts, all counts of that side are zero. Extra columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from metricloom.llm.common import Shared, map_arrow, text_or_empty
from metricloom.session import materialize

MAX_WORDS = 1
BUCKETS = 10_000
LEAST_WORDS = 20
PERCENT = 10
SEED = 2024
# Scores are thousandths of a logarithm, so there are some hundreds of bins whatever the number of documents.
BIN = 100

# Letters A to Z lowered; everything else below U+0080 but letters and digits separates.
WORD_BYTES = frozenset([*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)])
PLAIN = bytes(low if (low := b + 32 if 0x41 <= b <= 0x5A else b) in WORD_BYTES else 0x20 for b in range(256))
SEPARATORS = regex.compile(rb" {2,}")


def patterns(longest: int) -> list[regex.Pattern]:
    """For each length, a pattern that matches so many words from the start of one to the end of one."""
    return [regex.compile(rb"(?<![^ ])[^ ]++(?: [^ ]++){%d}" % (k - 1)) for k in range(1, longest + 1)]


class Scanner:
    """Buckets of the n-grams of a text, of 1 to ``longest`` words."""

    UNSHIPPED = ("patterns",)

    def __init__(self, longest: int, buckets: int):
        self.longest, self.buckets = longest, buckets
        self.kind = "<u2" if buckets <= 1 << 16 else "<u4"
        self.ready()

    def ready(self) -> None:
        self.patterns = patterns(self.longest)

    def __getstate__(self) -> dict[str, object]:
        return {k: v for k, v in self.__dict__.items() if k not in self.UNSHIPPED}

    def __setstate__(self, state: dict[str, object]) -> None:
        self.__dict__.update(state)
        self.ready()

    def scan(self, text: str) -> tuple[int, np.ndarray]:
        """The number of words, and the bucket of each n-gram, repeats included."""
        plain = SEPARATORS.sub(b" ", text.encode("utf-8").translate(PLAIN))
        crc, sums, words = zlib.crc32, [], 0
        for pattern in self.patterns:
            sums += [crc(m[0]) for m in pattern.finditer(plain, overlapped=True)]
            words = words or len(sums)
        return words, (np.array(sums, np.uint32) % self.buckets).astype(self.kind)


def features(docs: DataFrame, columns: list[str], longest: int, buckets: int) -> DataFrame:
    """``columns`` of ``docs`` and ``n_words, n_features, buckets``, the last as packed numbers."""
    shared = Shared(docs.sparkSession, Scanner(longest, buckets))

    def rows(batch: pa.RecordBatch) -> dict[str, object]:
        scanned = [shared.value.scan(t) for t in batch["__text"].to_pylist()]
        return {
            **{c: batch[c] for c in columns},
            "n_words": [n for n, _ in scanned],
            "n_features": [len(b) for _, b in scanned],
            "buckets": [b.tobytes() for _, b in scanned],
        }

    kinds = dict(docs.dtypes)
    schema = "".join(f"{c} {kinds[c]}, " for c in columns) + "n_words bigint, n_features bigint, buckets binary"
    return map_arrow(docs.select(*columns, text_or_empty().alias("__text")), schema, rows, 256)


def bucket_counts(found: DataFrame, buckets: int) -> np.ndarray:
    """How many features of all rows fall in each bucket. Each batch of rows gives one row per bucket in use."""
    kind = Scanner(0, buckets).kind

    def rows(batch: pa.RecordBatch) -> dict[str, object]:
        packed = batch["buckets"]
        seen = np.bincount(np.frombuffer(b"".join(packed.to_pylist()), kind), minlength=buckets)
        used = np.flatnonzero(seen)
        return {"bucket": used, "n": seen[used]}

    per_batch = map_arrow(found.select("buckets"), "bucket int, n bigint", rows, 1 << 14)
    # The sum over batches in one task first, then over tasks: at most one row per bucket and task is shuffled.
    out = np.zeros(buckets, np.int64)
    for r in per_batch.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r["bucket"]] = r["n"]
    return out


def gains(documents: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of a bucket's smoothed share in the target and in the documents, rounded down."""
    n = len(documents)
    all_docs, all_target = int(documents.sum()) + n, int(target.sum()) + n
    return np.array(
        [math.floor(1000 * math.log((int(t) + 1) * all_docs / ((int(s) + 1) * all_target))) for s, t in zip(documents, target, strict=True)], np.int64
    )


def weighed(found: DataFrame, gain: np.ndarray) -> DataFrame:
    """``row, doc_id, n_words, n_features, weight``: the mean gain of a row's features, rounded down."""
    shared = Shared(found.sparkSession, gain)
    kind = Scanner(0, len(gain)).kind

    def rows(batch: pa.RecordBatch) -> dict[str, object]:
        packed = batch["buckets"].to_pylist()
        sizes = batch["n_features"].to_numpy()
        ends = np.cumsum(sizes)
        totals = np.concatenate([[0], np.cumsum(shared.value[np.frombuffer(b"".join(packed), kind)])])
        sums = totals[ends] - totals[ends - sizes]
        weight = np.where(sizes > 0, sums // np.maximum(sizes, 1), 0)
        return {**{c: batch[c] for c in ("row", "doc_id", "n_words", "n_features")}, "weight": weight}

    return map_arrow(found, "row bigint, doc_id bigint, n_words bigint, n_features bigint, weight bigint", rows, 1 << 12)


def noise(seed: int) -> Column:
    """Gumbel noise in thousandths, fixed by ``doc_id``."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name.cast("binary"), 256), 1, 8), 16, 10).cast("bigint")
    return F.floor(-1000 * F.ln(-F.ln((h + F.lit(0.5)) / F.lit(4294967296.0)))).cast("bigint")


def ranked(scored: DataFrame, least_words: int, percent: int) -> DataFrame:
    """``scored`` with ``rank``: 1, 2, 3 ... for the ``percent`` of the rows with enough words that score highest."""
    scored = scored.withColumn("in_draw", F.col("n_words") >= least_words)
    bins = scored.where("in_draw").groupBy(F.floor(F.col("score") / BIN).alias("bin")).count().collect()
    wanted = sum(b["count"] for b in bins) * percent // 100
    cut, above = 0, 0
    for b in sorted(bins, key=lambda b: -b["bin"]):
        if above < wanted:
            cut, above = b["bin"] * BIN, above + b["count"]
    none = F.lit(None).cast("bigint")
    if not wanted:
        return scored.withColumn("rank", none)
    able = F.col("in_draw") & (F.col("score") >= cut)
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("row").asc()]
    sorted_rows = scored.where(able).repartitionByRange(*order).sortWithinPartitions(*order)
    placed = materialize(
        sorted_rows.withColumns({"part": F.spark_partition_id(), "place": F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1) + 1}), "resampling-order"
    )
    # One row per task of the sort.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = placed.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    starts = materialize(parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start")), "resampling-starts")
    rank = F.col("start") + F.col("place")
    drawn = placed.join(starts, "part").select(*scored.columns, F.when(rank <= wanted, rank).alias("rank"))
    return drawn.unionByName(scored.where(~able).withColumn("rank", none))


def resample(
    docs: DataFrame,
    target: DataFrame,
    longest: int = MAX_WORDS,
    buckets: int = BUCKETS,
    least_words: int = LEAST_WORDS,
    percent: int = PERCENT,
    seed: int = SEED,
) -> DataFrame:
    """``doc_id, n_words, n_features, weight, score, rank`` of every row of ``docs`` (``doc_id, text``); ``rank`` is null where not drawn."""
    numbered = docs.select("doc_id", "text", F.monotonically_increasing_id().alias("row"))
    found = materialize(features(numbered, ["row", "doc_id"], longest, buckets), "resampling-features")
    of_target = features(target.select("text"), [], longest, buckets)
    gain = gains(bucket_counts(found, buckets), bucket_counts(of_target, buckets))
    scored = materialize(weighed(found, gain).withColumn("score", F.col("weight") + noise(seed)), "resampling-scores")
    return ranked(scored, least_words, percent).select("doc_id", "n_words", "n_features", "weight", "score", "rank")


def drawn_documents(docs: DataFrame, target: DataFrame, **options: int) -> DataFrame:
    """The drawn rows of ``docs`` with all their columns, and ``rank`` unless ``docs`` has such a column; ``doc_id`` must tell the rows apart."""
    drawn = resample(docs, target, **options).where("rank is not null").select("doc_id", F.col("rank").alias("__rank"))
    rows = docs.select("doc_id", F.struct("*").alias("__row")).join(drawn, "doc_id")
    return rows.select("__row.*", *([] if "rank" in docs.columns else [F.col("__rank").alias("rank")]))


# Separators and words are ASCII rules, so a text is lowered by translate(); the checksum is taken once per distinct word.
SQL = """
WITH RECURSIVE steps(byte, step, value) AS (
  SELECT i, 0, i FROM range(256) t(i)
  UNION ALL SELECT byte, step + 1, CASE WHEN value % 2 = 1 THEN xor(value // 2, 3988292384) ELSE value // 2 END FROM steps WHERE step < 8),
crc AS (SELECT list(value ORDER BY byte) AS entries FROM steps WHERE step = 8),
words AS (
  SELECT 'd' AS side, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  FROM documents
  UNION ALL
  SELECT 't', NULL, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')
  FROM benchmark),
each AS (SELECT side, doc_id, unnest(w) AS word FROM words),
hashed AS (
  SELECT word, xor(list_reduce(list_prepend(4294967295, list_transform(range(length(hex(encode(word))) // 2),
      lambda i: CAST('0x' || substr(hex(encode(word)), 2 * i + 1, 2) AS BIGINT))),
    lambda c, b: xor(c // 256, list_extract(entries, xor(c, b) % 256 + 1))), 4294967295) % 10000 AS bucket
  FROM (SELECT DISTINCT word FROM each), crc),
per_bucket AS (
  SELECT b.i AS bucket, coalesce(s, 0) AS s, coalesce(t, 0) AS t
  FROM range(10000) b(i) LEFT JOIN (
    SELECT bucket, count(*) FILTER (side = 'd') AS s, count(*) FILTER (side = 't') AS t FROM each JOIN hashed USING (word) GROUP BY bucket) c
  ON c.bucket = b.i),
gained AS (
  SELECT bucket, CAST(floor(1000 * ln(CAST((t + 1) * (sum(s) OVER () + 10000) AS DOUBLE) / CAST((s + 1) * (sum(t) OVER () + 10000) AS DOUBLE))) AS BIGINT) AS gain
  FROM per_bucket),
sums AS (
  SELECT doc_id, CAST(sum(gain) AS BIGINT) AS total FROM each JOIN hashed USING (word) JOIN gained USING (bucket) WHERE side = 'd' GROUP BY doc_id),
scored AS (
  SELECT w.doc_id, CAST(len(w) AS BIGINT) AS n_features,
    CASE WHEN len(w) = 0 THEN 0 ELSE CAST(floor(total / len(w)) AS BIGINT) END AS weight,
    CAST('0x' || substr(sha256('2024:' || w.doc_id), 1, 8) AS BIGINT) AS h
  FROM words w LEFT JOIN sums USING (doc_id) WHERE side = 'd'),
drawn AS (
  SELECT doc_id, n_features, weight, weight + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score FROM scored),
placed AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, 10 * count(*) OVER () // 100 AS wanted FROM drawn WHERE n_features >= 20)
SELECT d.doc_id, n_features, weight, score, CASE WHEN place <= wanted THEN place END AS rank
FROM drawn d LEFT JOIN placed p ON d.doc_id = p.doc_id
"""
