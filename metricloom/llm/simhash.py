"""Near-duplicates by SimHash fingerprints and pivot distance tables.

Fingerprints link when at most ``RADIUS`` bits differ. Equal fingerprints are one node from the start. Two
that link agree in one of four 16-bit blocks, and in one of four 12-bit parts of the other 48 bits, so placing
each fingerprint under its 16 combined keys loses no link. Under a key, a table holds the Hamming distances to
``PIVOTS`` reference fingerprints. By the triangle inequality two linked fingerprints differ by no more than
``RADIUS`` in any coordinate: rows are sorted by the first and compared inside its window only, the other
coordinates discard most of what is left, and the rest is verified bit by bit. Pairs already connected are
skipped, and a key gives only a spanning forest of its links, never all pairs of a group.

A key with more than ``CHUNK`` fingerprints is dealt in chunks, and every two chunks meet in a task of their own, so
that no task holds more than two.

Pivot distances alone cannot place fingerprints: one coordinate of random 64-bit values keeps almost half of
all pairs, whence the keys.

Defined results: a null or empty text has fingerprint zero. A null ``doc_id`` is larger than any other, and a
component of null ids only has a null ``component_id``. Repeated rows share a fingerprint. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from metricloom.llm.common import id_keys, map_arrow, packed, text_or_empty
from metricloom.llm.graph import components
from metricloom.session import materialize

SHINGLE_WORDS = 3
SEED = 42
RADIUS = 3
PIVOTS = 16
CHUNK = 4096
HASHES_AT_ONCE = 1 << 16
ROWS_AT_ONCE = 1 << 17

LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
BITS = (np.arange(256)[:, None] >> np.arange(8)[None, :]) & 1


def shingle_hashes(text: str, width: int) -> Iterator[np.ndarray]:
    """Hashes of the word shingles of a text in pieces, repeats included; a text of fewer words is one shingle."""
    words = text.encode("utf-8", "surrogatepass").translate(LOWER).split()
    if not words:
        return
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    width = min(width, len(words))
    first, last = starts[: len(words) - width + 1].tolist(), ends[width - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    for at in range(0, len(first), HASHES_AT_ONCE):
        pairs = zip(first[at : at + HASHES_AT_ONCE], last[at : at + HASHES_AT_ONCE], strict=True)
        yield np.array([digest(joined[a:b], SEED) for a, b in pairs], "<u8")


def fingerprint(text: str) -> int:
    """64-bit SimHash over the word shingles of a text, repeats included."""
    counts, n = np.zeros((8, 256), np.int64), 0
    for hashes in shingle_hashes(text, SHINGLE_WORDS):
        n += len(hashes)
        by_byte = hashes.view(np.uint8).reshape(-1, 8) + (np.arange(8) * 256)
        counts += np.bincount(by_byte.ravel(), minlength=2048).reshape(8, 256)
    majority = (counts @ BITS).ravel() * 2 > n
    return int(np.packbits(majority, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id, text_hash, fp`` per row; ``fp`` is the fingerprint as a signed bigint."""

    def rows(batch: pa.RecordBatch) -> dict[str, object]:
        found = np.array([fingerprint(t) for t in batch["text"].to_pylist()], np.uint64).view(np.int64)
        return {"doc_id": batch["doc_id"], "text_hash": batch["text_hash"], "fp": found}

    slim = docs.select("doc_id", text_or_empty().alias("text")).withColumn("text_hash", F.xxhash64("text"))
    return map_arrow(slim, "doc_id bigint, text_hash bigint, fp bigint", rows)


def pivots() -> np.ndarray:
    """Reference fingerprints: random, but the same always."""
    return np.random.default_rng(SEED).integers(0, 1 << 64, PIVOTS, dtype=np.uint64)


def key_columns() -> list[Column]:
    """The 16 keys of column ``fp``: which block and part, and their bits."""
    fp, keys = F.col("fp"), []
    for block in range(4):
        bits = F.shiftrightunsigned(fp, 16 * block).bitwiseAND(0xFFFF)
        low = fp.bitwiseAND((1 << 16 * block) - 1)
        rest = low if block == 3 else low.bitwiseOR(F.shiftleft(F.shiftrightunsigned(fp, 16 * block + 16), 16 * block))
        for part in range(4):
            piece = F.shiftrightunsigned(rest, 12 * part).bitwiseAND(0xFFF)
            name = F.lit((block * 4 + part) << 28).cast("bigint")
            keys.append(name.bitwiseOR(F.shiftleft(bits, 12)).bitwiseOR(piece))
    return keys


def connect(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Join the trees of each pair; every label is then the smallest row of its tree."""
    while True:
        la, lb = label[a], label[b]
        apart = la != lb
        if not apart.any():
            return label
        np.minimum.at(label, np.maximum(la, lb)[apart], np.minimum(la, lb)[apart])
        while True:
            further = label[label]
            if np.array_equal(further, label):
                break
            label = further


def link_rows(group: np.ndarray, first: np.ndarray, fp: np.ndarray) -> np.ndarray:
    """Label of every row; rows are sorted by group and first coordinate, and only rows of a group link."""
    n = len(fp)
    label = np.arange(n)
    table = np.bitwise_count(fp[:, None] ^ pivots()[None, 1:]).astype(np.int8)
    active, step = np.arange(n), 0
    while len(active):
        step += 1
        active = active[active + step < n]
        other = active + step
        near = (group[other] == group[active]) & (first[other] - first[active] <= RADIUS)
        active = active[near]
        one, two = active, active + step
        apart = label[one] != label[two]
        one, two = one[apart], two[apart]
        for p in range(table.shape[1]):
            if not len(one):
                break
            close = np.abs(table[one, p] - table[two, p]) <= RADIUS
            one, two = one[close], two[close]
        same = np.bitwise_count(fp[one] ^ fp[two]) <= RADIUS
        if same.any():
            label = connect(label, one[same], two[same])
    return label


def link_partition() -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``mapInArrow`` function: rows ``key, cell, first, fp`` in that order in, edges ``a, b`` out."""

    def edges(rows: np.ndarray) -> pa.RecordBatch:
        group = np.concatenate([[0], np.cumsum((rows[1:, 0] != rows[:-1, 0]) | (rows[1:, 1] != rows[:-1, 1]))])
        # A row alone under its key has no partner.
        size = np.bincount(group)[group] > 1
        rows, group = rows[size], group[size]
        fp = np.ascontiguousarray(rows[:, 3]).view(np.uint64)
        label = link_rows(group, rows[:, 2], fp)
        moved = label != np.arange(len(label))
        return pa.record_batch({"a": pa.array(rows[moved, 3]), "b": pa.array(rows[label[moved], 3])})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        count = 0
        for batch in batches:
            held.append(np.column_stack([batch[c].to_numpy() for c in ("key", "cell", "first", "fp")]))
            count += batch.num_rows
            if count >= ROWS_AT_ONCE:
                rows = np.concatenate(held)
                # The last group may go on in the next batch.
                same = (rows[:, 0] == rows[-1, 0]) & (rows[:, 1] == rows[-1, 1])
                cut = int(np.argmax(same))
                if cut:
                    yield edges(rows[:cut])
                held, count = [rows[cut:]], len(rows) - cut
        if count:
            yield edges(np.concatenate(held))

    return run


def links(distinct: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """Edges ``a, b`` that connect every two fingerprints (column ``fp``, distinct) within the radius."""
    keyed = distinct.select("fp", F.explode(F.array(*key_columns())).alias("key"))
    parts = F.ceil(F.col("count") / chunk).cast("int")
    large = materialize(keyed.groupBy("key").count().where(F.col("count") > chunk).select("key", parts.alias("parts")), "simhash-large-keys")
    mine = F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int")
    pairs = F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda other: F.least(mine, other) * F.col("parts") + F.greatest(mine, other))
    cells = F.when(F.col("parts").isNull(), F.array(F.lit(0))).otherwise(pairs).cast("array<bigint>")
    first = F.bit_count(F.col("fp").bitwiseXOR(F.lit(int(pivots().view(np.int64)[0]))))
    placed = (
        keyed.join(large, "key", "left")
        .select("key", F.explode(cells).alias("cell"), first.cast("bigint").alias("first"), "fp")
        .repartition("key", "cell")
        .sortWithinPartitions("key", "cell", "first")
    )
    return placed.mapInArrow(link_partition(), "a bigint, b bigint")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id, text_hash, fp, root, component_id`` for every row; rows of a component share ``root``."""
    slim = materialize(fingerprints(docs), "simhash-fingerprints")
    distinct = materialize(slim.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-distinct")
    roots = components(links(distinct.select("fp")))
    rooted = distinct.join(roots, distinct["fp"] == roots["node"], "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    members = materialize(rooted.select("fp", "root").join(named, "root"), "simhash-members")
    return slim.join(members, "fp").select("doc_id", "text_hash", "fp", "root", "component_id")


def one_of_each(docs: DataFrame, rooted: DataFrame) -> DataFrame:
    """One row per ``root`` of ``rooted`` (``doc_id, text_hash, root``), that of the smallest ``doc_id``, with all columns of ``docs``."""
    keys = ["no_id", "id", "text_hash"]
    kept = rooted.groupBy("root").agg(F.min(F.struct(id_keys()["no_id"].alias("no_id"), id_keys()["id"].alias("id"), "text_hash")).alias("k")).select("k.*")
    keyed = packed(docs, **id_keys(), text_hash=F.xxhash64(text_or_empty()))
    return keyed.join(kept, keys).dropDuplicates(keys).select("row.*")


def deduplicate(docs: DataFrame) -> DataFrame:
    """One row of each component, that of the smallest ``doc_id``, with all columns of ``docs``."""
    return one_of_each(docs, near_duplicates(docs))


def fingerprint_hex() -> Column:
    return F.lpad(F.lower(F.hex("fp")), 16, "0")
