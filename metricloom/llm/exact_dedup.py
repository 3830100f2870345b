"""Exact deduplication with Patricia tries.

Texts are equal when they are identical after each run of white space became one blank. A first, map-only
step inserts the texts of each input split into a trie of its own, so that a group of copies leaves a split
as one row. These rows are dealt by length and content hash and inserted, as whole byte strings, into the
partition's compressed radix trie, whose terminal nodes keep the smallest ``doc_id`` and the number of
copies. A trie that outgrows its bound is written out whole and a new one is begun.

Groups of more than ``HOT_COPIES`` rows are known from a count of the keys. They are dealt in ``SALTS``
parts first, and the parts' owners meet in a second trie. All other texts are shuffled once.

Defined results: a null text counts as empty. A null ``doc_id`` is larger than any other. Of rows that
repeat both text and ``doc_id`` one is kept. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metricloom.llm.common import SPACES, id_keys, packed, text_or_empty
from metricloom.session import materialize

HOT_COPIES = 10_000
SALTS = 64
TRIE_BYTES = 32 << 20
ROWS_AT_ONCE = 256
KEY = ["length", "hash"]
OWNERS = "length bigint, hash bigint, text string, keep_id bigint, group_size bigint"


class Trie:
    """A compressed radix trie over byte strings. A node is ``[label, children by first byte, owner]``;
    the owner of a terminal node is ``[smallest doc_id, copies, text key]``."""

    def __init__(self) -> None:
        self.root: list = [b"", {}, None]
        self.held = 0

    def insert(self, key: bytes, doc_id: int | None, copies: int, about: object) -> None:
        node, at = self.root, 0
        while True:
            if at == len(key):
                if node[2] is None:
                    node[2] = [doc_id, copies, about]
                else:
                    owner = node[2]
                    owner[1] += copies
                    if doc_id is not None and (owner[0] is None or doc_id < owner[0]):
                        owner[0] = doc_id
                return
            child = node[1].get(key[at])
            if child is None:
                node[1][key[at]] = [key[at:], {}, [doc_id, copies, about]]
                self.held += len(key) - at + 200
                return
            label = child[0]
            if not key.startswith(label, at):
                shared = common_length(label, key[at : at + len(label)])
                node[1][label[0]] = [label[:shared], {label[shared]: child}, None]
                child[0] = label[shared:]
                child = node[1][label[0]]
                self.held += 200
            at += len(child[0])
            node = child

    def owners(self) -> Iterator[tuple[bytes, int | None, int, object]]:
        """Every terminal node: key, smallest id, copies, and what came with its first insertion."""
        stack = [(b"", self.root)]
        while stack:
            before, node = stack.pop()
            key = before + node[0]
            if node[2] is not None:
                yield key, *node[2]
            stack.extend((key, child) for child in node[1].values())


def common_length(a: bytes, b: bytes) -> int:
    """Length of the common prefix, by halving."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        middle = (low + high + 1) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle - 1
    return low


def trie_owners(bound: int = TRIE_BYTES) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``mapInArrow`` function: rows of ``OWNERS`` in, one row per distinct text and bound of a trie out."""
    names = ("length", "hash", "text", "keep_id", "group_size")

    def flush(trie: Trie) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        for key, doc_id, copies, about in trie.owners():
            out.append((*about, key.decode("utf-8"), doc_id, copies))
            if len(out) == ROWS_AT_ONCE:
                yield batch_of(out)
                out = []
        if out:
            yield batch_of(out)

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        length, hashes, texts, ids, copies = zip(*rows, strict=True)
        columns = (pa.array(length, pa.int64()), pa.array(hashes, pa.int64()), pa.array(texts, pa.string()), pa.array(ids, pa.int64()), pa.array(copies, pa.int64()))
        return pa.record_batch(dict(zip(names, columns, strict=True)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, last = Trie(), None
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(start, ROWS_AT_ONCE).to_pydict()
                for length, h, text, doc_id, copies in zip(*(part[n] for n in names), strict=True):
                    if trie.held > bound and (length, h) != last:
                        yield from flush(trie)
                        trie = Trie()
                    last = (length, h)
                    trie.insert(text.encode("utf-8"), doc_id, copies, last)
        yield from flush(trie)

    return run


def normalised(docs: DataFrame) -> DataFrame:
    """``doc_id, text, length, hash`` with white space folded."""
    folded = docs.select("doc_id", F.regexp_replace(text_or_empty(), SPACES, " ").alias("text"))
    return folded.withColumns({"length": F.octet_length("text").cast("bigint"), "hash": F.xxhash64("text")})


def text_groups(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, keep_id, group_size, kept, text_sha256, length, hash``."""
    slim = materialize(
        normalised(docs).select("doc_id", *KEY, F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"), F.monotonically_increasing_id().alias("row")),
        "dedup-keys",
    )
    hot = materialize(slim.groupBy(*KEY).count().where(F.col("count") > HOT_COPIES).select(*KEY, F.lit(True).alias("hot")), "dedup-hot-keys")
    # One row per distinct text of a split; the trie is flushed whole when it reaches its bound.
    per_split = (
        normalised(docs)
        .select(*KEY, "text", F.col("doc_id").alias("keep_id"), F.lit(1).cast("bigint").alias("group_size"))
        .mapInArrow(trie_owners(), OWNERS)
        .join(hot, KEY, "left")
        .withColumn("salt", F.when(F.col("hot"), F.spark_partition_id() % SALTS).otherwise(0))
    )
    first = per_split.repartition(*KEY, "salt").sortWithinPartitions(*KEY)
    owners = first.select(*KEY, "text", "keep_id", "group_size").mapInArrow(trie_owners(), OWNERS)
    once = materialize(
        owners.join(hot, KEY, "left").select(
            *KEY, F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"), "keep_id", "group_size", F.when(F.col("hot"), F.col("text")).alias("text")
        ),
        "dedup-owners",
    )
    merged = (
        once.where(F.col("text").isNotNull())
        .select(*KEY, "text", "keep_id", "group_size")
        .repartition(*KEY)
        .sortWithinPartitions(*KEY)
        .mapInArrow(trie_owners(), OWNERS)
        .select(*KEY, F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"), "keep_id", "group_size")
    )
    final = once.where(F.col("text").isNull()).drop("text").unionByName(merged)
    grouped = slim.join(final, [*KEY, "text_sha256"])
    # Which row stands for a repeated doc_id with the same text; hardly ever any.
    repeated = materialize(
        slim.groupBy("doc_id", *KEY).agg(F.count(F.lit(1)).alias("times"), F.min("row").alias("first_row")).where("times > 1").drop("times"),
        "dedup-repeats",
    )
    same = grouped["doc_id"].eqNullSafe(repeated["doc_id"]) & (grouped["length"] == repeated["length"]) & (grouped["hash"] == repeated["hash"])
    kept = grouped["doc_id"].eqNullSafe(F.col("keep_id")) & (F.col("first_row").isNull() | (F.col("row") == F.col("first_row")))
    return grouped.join(repeated, same, "left").select(
        grouped["doc_id"], "keep_id", "group_size", kept.alias("kept"), "text_sha256", grouped["length"], grouped["hash"]
    )


def deduplicate(docs: DataFrame) -> DataFrame:
    """The kept rows of ``docs``, with all their columns."""
    keys = ["id", "no_id", *KEY]
    kept = text_groups(docs).where("kept").select(*[c.alias(n) for n, c in id_keys().items()], *KEY)
    folded = F.regexp_replace(text_or_empty(), SPACES, " ")
    keyed = packed(docs, **id_keys(), length=F.octet_length(folded).cast("bigint"), hash=F.xxhash64(folded))
    # The join leaves the rows dealt and sorted by the keys, so repeated rows go without another shuffle.
    return keyed.join(kept, keys).dropDuplicates(keys).select("row.*")


SQL = """
WITH n AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
  doc_id = min(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
FROM n
"""
