"""Nearest neighbours by inner product along shifted Hilbert curves.

Equal vectors are one class, known by its smallest ids, so that a very common vector costs as much as any other.
Classes are projected to a few dimensions in several random ways, shifted, and ordered along a Hilbert curve in
each. Spark range-partitions every ordering and cuts it into blocks; a query first visits its own block and the
two beside it in each ordering, and the neighbours found there are merged and reranked on the original vectors.

Windows of keys alone do not reach the recall asked for where vectors fill all their dimensions: on random unit
vectors of 64 dimensions a true neighbour lies hardly nearer on a curve than any other row. So the windows' result
serves as a bound: blocks of the first ordering know their centre and radius, and a query goes on to visit
those that could hold something better than its present last neighbour. The result is exact; on clustered
vectors few blocks are visited, on random ones nearly all, in query chunks against blocks.

Defined results: vectors that are null, zero, hold a null or non-finite component, or differ in length from most take
no part, nor does a null ``vec_id``. Rows that repeat a ``vec_id`` are separate candidates, but none is a neighbour of
a query of its own id. Ties go to the smaller id. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from metricloom.session import materialize

NEIGHBOURS = 20
CURVES = 4
PROJECTED = 8
BITS = 7
BLOCK_ROWS = 4096
QUERY_CHUNK = 1024
PAIRS_AT_ONCE = 1 << 16
SEED = 7


def usable(vectors: DataFrame) -> DataFrame:
    """``vec_id, v`` of the rows that take part. Vectors of floats are moved as such and become doubles where they
    are multiplied; any other numbers are doubles from here on."""
    kind = "array<float>" if dict(vectors.dtypes)["embedding"] == "array<float>" else "array<double>"
    v = F.col("embedding").cast(kind)
    clean = vectors.select("vec_id", v.alias("v")).where(
        "vec_id is not null and v is not null and size(v) > 0 and forall(v, x -> x is not null and not isnan(x) and abs(double(x)) < double('inf')) and exists(v, x -> x <> 0)"
    )
    usual = clean.groupBy(F.size("v").alias("size")).count().orderBy(F.desc("count"), "size").limit(1).select("size")
    sizes = [r["size"] for r in usual.collect()]
    return clean.where(F.size("v") == (sizes[0] if sizes else 0))


def classes(rows: DataFrame, neighbours: int) -> DataFrame:
    """``class_id, ids, v``: one row per distinct vector, with as many of its smallest ids as can ever be asked for.

    Ranks beyond that bound are cut in each task before the shuffle.
    """
    by_vector = Window.partitionBy("v").orderBy("vec_id")
    few = rows.withColumn("place", F.row_number().over(by_vector)).where(F.col("place") <= neighbours + 1)
    return few.groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")).withColumn("class_id", F.col("ids")[0])


def hilbert_keys(points: np.ndarray, bits: int) -> np.ndarray:
    """Places on the Hilbert curve of integer points ``(n, d)`` below ``2**bits``; ``d * bits`` is at most 63.

    Works from the highest bit down: where a coordinate's bit is set, the lower bits of the first one are
    inverted, else exchanged with those of the first; Gray decoding of the bits then gives the place.
    """
    x = points.astype(np.int64).T.copy()
    d = len(x)
    for bit in range(bits - 1, 0, -1):
        low = (1 << bit) - 1
        for i in range(d):
            is_set = (x[i] >> bit & 1).astype(bool)
            swap = np.where(is_set, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(is_set, x[0] ^ low, x[0] ^ swap)
            x[i] ^= swap
    for i in range(1, d):
        x[i] ^= x[i - 1]
    parity = np.zeros_like(x[0])
    for bit in range(bits - 1, 0, -1):
        parity ^= np.where(x[d - 1] >> bit & 1, (1 << bit) - 1, 0)
    x ^= parity
    key = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for i in range(d):
            key = key << 1 | (x[i] >> bit & 1)
    return key


def keyed(found: DataFrame, curves: int) -> DataFrame:
    """``curve, key`` and the class's columns: one row per class and curve."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            v = matrix(batch["v"])
            unit = v / np.linalg.norm(v, axis=1, keepdims=True)
            for curve in range(curves):
                random = np.random.default_rng((SEED, curve))
                axes = np.linalg.qr(random.standard_normal((v.shape[1], min(PROJECTED, v.shape[1]))))[0]
                # Unit vectors spread by about one over the root of their length in each direction.
                spread = unit @ axes * np.sqrt(v.shape[1]) + random.uniform(-0.5, 0.5, axes.shape[1])
                cells = np.clip((spread + 4) / 8 * (1 << BITS), 0, (1 << BITS) - 1).astype(np.int64)
                key = pa.array(hilbert_keys(cells, BITS))
                yield pa.record_batch({"curve": pa.array([curve] * batch.num_rows, pa.int32()), "key": key, **{c: batch[c] for c in ("class_id", "ids", "v")}})

    kind = dict(found.dtypes)["v"]
    return found.select("class_id", "ids", "v").mapInArrow(run, f"curve int, key bigint, class_id bigint, ids array<bigint>, v {kind}")


def matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def blocked(rows: DataFrame) -> DataFrame:
    """Rows in the order of their curve, cut into blocks of at most ``BLOCK_ROWS``: adds ``part, block``."""
    ordered = rows.repartitionByRange("curve", "key", "class_id").sortWithinPartitions("curve", "key", "class_id")
    numbered = ordered.withColumns({"part": F.spark_partition_id(), "row": F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)})
    return numbered.withColumn("block", F.floor(F.col("row") / BLOCK_ROWS)).drop("row")


def block_name() -> Column:
    """A number for ``curve, part, block``."""
    return F.col("curve").cast("bigint") * (1 << 48) + F.col("part").cast("bigint") * (1 << 24) + F.col("block")


def best_in_blocks(neighbours: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``mapInArrow`` function: rows sorted by ``group, is_query`` in; per group every query's best classes of it out.

    A group is a block with the queries that visit it: at most ``BLOCK_ROWS`` classes, whose rows come first.
    """

    def best(held: list[dict]) -> pa.RecordBatch | None:
        is_query = np.concatenate([h["is_query"] for h in held])
        v = np.concatenate([h["v"] for h in held])
        names = np.concatenate([h["class_id"] for h in held])
        queries, found = np.flatnonzero(is_query), np.flatnonzero(~is_query)
        if not len(queries) or not len(found):
            return None
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        some, longest = min(neighbours + 2, len(found)), np.linalg.norm(v[found], axis=1).max()
        for start in range(0, len(queries), QUERY_CHUNK):
            part = queries[start : start + QUERY_CHUNK]
            scores = v[part] @ v[found].T
            least = np.partition(scores, len(found) - some, axis=1)[:, len(found) - some]
            # What a product may differ by from the sum below; whoever could reach the last place is looked at.
            margin = 1e-13 * v.shape[1] * np.linalg.norm(v[part], axis=1) * longest
            which, place = np.nonzero(scores >= (least - margin)[:, None])
            # The same sum in the same order wherever a pair meets.
            exact = np.concatenate(
                [(v[part[which[i : i + PAIRS_AT_ONCE]]] * v[found[place[i : i + PAIRS_AT_ONCE]]]).sum(axis=1) for i in range(0, len(which), PAIRS_AT_ONCE)]
            )
            order = np.lexsort((names[found[place]], -exact, which))
            which, place, exact = which[order], place[order], exact[order]
            # Each query's best by score and class id.
            rank = np.arange(len(which)) - np.searchsorted(which, which)
            best_ones = rank < some
            out.append((names[part[which[best_ones]]], names[found[place[best_ones]]], exact[best_ones]))
        asked, chosen, exact = (np.concatenate(c) for c in zip(*out, strict=True))
        return pa.record_batch({"query": pa.array(asked), "class_id": pa.array(chosen), "score": pa.array(exact)})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        current = None
        for batch in batches:
            if not batch.num_rows:
                continue
            group = batch["group"].to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(group)]
            v = matrix(batch["v"])
            columns = {"is_query": batch["is_query"].to_numpy(zero_copy_only=False), "class_id": batch["class_id"].to_numpy(), "v": v}
            for a, b in zip(cuts, cuts[1:], strict=False):
                if group[a] != current:
                    if held and (out := best(held)) is not None:
                        yield out
                    held, current = [], group[a]
                held.append({k: c[a:b] for k, c in columns.items()})
        if held and (out := best(held)) is not None:
            yield out

    return run


def visit(visits: DataFrame, blocks: DataFrame, neighbours: int) -> DataFrame:
    """``query, class_id, score``: for each ``query`` and ``name`` of ``visits`` (with its vector and a ``chunk`` of queries) the best
    classes of the block of that name. A block is sent to each chunk of queries that visits it."""
    wanted = visits.select("name", "chunk").distinct()
    rows = blocks.join(wanted, "name").select("name", "chunk", F.lit(False).alias("is_query"), "class_id", "v")
    asked = visits.select("name", "chunk", F.lit(True).alias("is_query"), F.col("query").alias("class_id"), "v")
    both = rows.unionByName(asked).withColumn("group", F.xxhash64("name", "chunk"))
    together = both.repartition("group").sortWithinPartitions("group", "is_query")
    return together.select("group", "is_query", "class_id", "v").mapInArrow(best_in_blocks(neighbours), "query bigint, class_id bigint, score double")


def nearest(vectors: DataFrame, queries_divide: int = 20, neighbours: int = NEIGHBOURS, curves: int = CURVES) -> DataFrame:
    """``query_id, rank, vec_id, score``: the nearest of every row whose ``vec_id`` divides by ``queries_divide``."""
    rows = materialize(usable(vectors), "ann-vectors")
    found = materialize(classes(rows, neighbours), "ann-classes")
    blocks = materialize(blocked(keyed(found, curves)).withColumn("name", block_name()), "ann-blocks")
    # Query ids, their classes, and a number of chunks that keeps each chunk's queries in bounds.
    ids = rows.where(F.pmod(F.col("vec_id"), F.lit(queries_divide)) == 0).select("vec_id", "v").distinct()
    asked = materialize(ids.join(found.select("v", "class_id"), "v").select(F.col("vec_id").alias("query_id"), "class_id"), "ann-queries")
    query_classes = asked.select("class_id").distinct()
    chunks = max(1, -(-query_classes.count() // QUERY_CHUNK))
    first = blocks.join(query_classes, "class_id").select(F.col("class_id").alias("query"), "v", "curve", "name", F.pmod(F.xxhash64("class_id"), F.lit(chunks)).alias("chunk"))
    in_order = Window.partitionBy("curve").orderBy("name")
    beside = blocks.select("curve", "name").distinct().select("name", F.lag("name").over(in_order).alias("left"), F.lead("name").over(in_order).alias("right"))
    near = first.join(beside, "name").withColumn("to", F.explode(F.array("name", "left", "right"))).where("to is not null")
    by_window = materialize(visit(near.select("query", "v", F.col("to").alias("name"), F.lit(-1).alias("chunk")), blocks, neighbours), "ann-windows")
    # The present last neighbour bounds what other blocks must offer. A class counts once for each of its ids.
    copies = found.select("class_id", F.size("ids").alias("copies"))
    scored = by_window.distinct().join(copies, "class_id")
    best_first = Window.partitionBy("query").orderBy(F.desc("score"), "class_id")
    filled = scored.withColumn("upto", F.sum("copies").over(best_first)).where(F.col("upto") >= neighbours + 1)
    bounds = filled.groupBy("query").agg(F.max("score").alias("bound"))
    home = blocks.where("curve = 0")
    size = F.max(F.size("v")).alias("width")
    width = (home.agg(size).collect()[0]["width"]) or 0
    centre = F.array(*[F.avg(F.col("v")[i]) for i in range(width)]) if width else F.array(F.lit(0.0))
    centres = home.groupBy("name").agg(centre.alias("centre"))
    apart = F.sqrt(F.aggregate(F.zip_with("v", "centre", lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda t, x: t + x))
    balls = materialize(home.join(centres, "name").groupBy("name").agg(F.max(apart).alias("radius"), F.first("centre").alias("centre")), "ann-balls")
    pending = materialize(
        first.where("curve = 0").select("query", "v", "chunk", F.col("name").alias("home")).join(bounds, "query", "left"), "ann-pending"
    )
    further = materialize(reachable(pending, balls, chunks), "ann-visits")
    by_bound = visit(further, home, neighbours)
    merged = by_window.unionByName(by_bound).distinct()
    # The best classes of each query class, expanded to ids for each of its query ids.
    kept = merged.withColumn("place", F.row_number().over(best_first)).where(F.col("place") <= neighbours + 1)
    with_ids = kept.join(found.select("class_id", "ids"), "class_id").select(F.col("query").alias("class_id"), "score", F.explode("ids").alias("vec_id"))
    pairs = asked.join(with_ids, "class_id").where("vec_id <> query_id")
    final = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return pairs.select("query_id", F.row_number().over(final).alias("rank"), "vec_id", "score").where(F.col("rank") <= neighbours)


def reachable(pending: DataFrame, balls: DataFrame, chunks: int) -> DataFrame:
    """The blocks that each pending query must still visit: those whose centre and radius allow a score of its bound.

    The queries are a stated set and meet the blocks' summaries, one row per block: each chunk of queries meets each
    of ``parts`` parts of the summaries in a group of its own, so the groups grow with the queries.
    """
    parts = 8
    spread = pending.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    dealt = balls.withColumns({"part": F.pmod(F.xxhash64("name"), F.lit(parts)).cast("int"), "chunk": F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(chunks - 1).cast("bigint")))})
    score = F.aggregate(F.zip_with("v", "centre", lambda a, b: a * b), F.lit(0.0), lambda t, x: t + x)
    length = F.sqrt(F.aggregate("v", F.lit(0.0), lambda t, x: t + x.cast("double") * x.cast("double")))
    most = score + F.col("radius") * length * (1 + 1e-9) + 1e-9
    both = spread.join(dealt, ["part", "chunk"]).where(F.col("bound").isNull() | (most >= F.col("bound")))
    return both.select("query", "v", "chunk", "name")
