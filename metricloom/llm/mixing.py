"""Mixing sources to target weights by hash-threshold histograms. Only DataFrame functions.

Every document has a fixed 48-bit hash. A source's fractional budget is met by all documents whose hash
lies below a threshold. The threshold is found level by level: sum words by source and the next twelve
bits of the hash, find the bucket in which the running sum crosses the budget, and sum again inside that
bucket alone. Nothing is sorted but the at most 4096 sums of a source.

Defined results: a null text has size 0; a null source is a source of its own, last in order. Rows equal
in ``doc_id`` and text have one hash and are taken together, so reruns agree. A source without words
has target 0 and takes nothing. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from metricloom.llm.common import NOT_SPACES, id_keys, packed, text_or_empty
from metricloom.session import materialize

WEIGHTS = (1, 2, 3)
MOST_REPEATS = 3
LEVELS = 4
LEVEL_BITS = 12


def document_hash() -> Column:
    """48 bits of an MD5 over ``doc_id`` and text."""
    key = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(" "), F.md5(text_or_empty().cast("binary")))
    return F.conv(F.substring(F.md5(key.cast("binary")), 1, LEVELS * LEVEL_BITS // 4), 16, 10).cast("bigint")


def sized(docs: DataFrame) -> DataFrame:
    """``doc_id, source, size, hash`` of every row."""
    return docs.select(
        "doc_id",
        "source",
        F.regexp_count(text_or_empty(), F.lit(NOT_SPACES)).cast("bigint").alias("size"),
        document_hash().alias("hash"),
    )


def targets(sizes: DataFrame) -> DataFrame:
    """``source, source_size, target`` per source.

    All sources share the total by weight, none beyond ``MOST_REPEATS`` times its size. With the sources
    in ascending order of size per weight, the capped ones come first; a source is capped if the
    share left by those before it exceeds its cap. One row per source is all that meets in a window.
    """
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    in_order = Window.orderBy(F.col("source").asc_nulls_last())
    weights = F.array(*map(F.lit, WEIGHTS))
    weighed = per_source.select(
        "source",
        "source_size",
        F.get(weights, (F.row_number().over(in_order) - 1) % len(WEIGHTS)).cast("bigint").alias("weight"),
    )
    by_cap = Window.orderBy((F.col("source_size") / F.col("weight")).asc(), F.col("source").asc_nulls_last())
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy(F.lit(1))
    cap = F.col("source_size") * MOST_REPEATS
    shared = weighed.select(
        "*",
        (F.sum("source_size").over(everything) - MOST_REPEATS * F.coalesce(F.sum("source_size").over(before), F.lit(0))).alias("left"),
        (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))).alias("left_weight"),
    ).withColumn("capped", cap * F.col("left_weight") <= F.col("left") * F.col("weight"))
    # The first uncapped source fixes the share of a unit of weight for all that follow.
    first = shared.withColumn(
        "level",
        F.min_by(F.struct("left", "left_weight"), F.when(~F.col("capped"), F.col("source_size") / F.col("weight"))).over(everything),
    )
    share = F.col("level.left").cast("double") / F.col("level.left_weight").cast("double") * F.col("weight").cast("double")
    return first.select(
        "source", "source_size", F.when(F.col("capped"), cap.cast("double")).otherwise(share).alias("target")
    )


def thresholds(slim: DataFrame, plan: DataFrame) -> DataFrame:
    """``source, threshold``: documents with a smaller hash are taken once more.

    ``plan`` has ``source`` and ``budget``. Of the last bucket, a single hash value, whichever side of it
    is nearer to the budget wins.
    """
    found = plan.select("source", "budget", F.lit(0).cast("bigint").alias("low"), F.lit(0).cast("bigint").alias("taken"))
    for level in range(LEVELS):
        shift = (LEVELS - 1 - level) * LEVEL_BITS
        inside = slim.alias("d").join(
            found.alias("f"),
            F.col("d.source").eqNullSafe(F.col("f.source"))
            & (F.shiftright("d.hash", shift + LEVEL_BITS) == F.shiftright("f.low", shift + LEVEL_BITS)),
        )
        sums = inside.groupBy(
            F.col("f.source").alias("source"), "budget", "low", "taken", F.shiftright("d.hash", shift).alias("bucket")
        ).agg(F.sum("d.size").alias("words"))
        running = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
        upto = sums.withColumn("before", F.col("taken") + F.coalesce(F.sum("words").over(running), F.lit(0)))
        # The last bucket that begins at or below the budget is where the sum crosses it.
        crossing = (
            upto.where(F.col("before") <= F.col("budget"))
            .groupBy("source", "budget")
            .agg(F.max(F.struct("bucket", "before", "words")).alias("b"))
        )
        found = materialize(
            crossing.select(
                "source",
                "budget",
                F.shiftleft("b.bucket", shift).alias("low"),
                F.col("b.before").alias("taken"),
                F.col("b.words").alias("words"),
            ),
            "mix-threshold",
        )
    nearer = F.col("budget") - F.col("taken") >= F.col("taken") + F.col("words") - F.col("budget")
    return found.select("source", (F.col("low") + nearer.cast("bigint")).alias("threshold"))


def mix(docs: DataFrame) -> DataFrame:
    """``doc_id, source, hash, size, source_size, target, copies, taken`` for every row of ``docs``."""
    slim = materialize(sized(docs), "mix-sizes")
    goals = targets(slim).withColumn(
        "rounds", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("bigint")
    )
    plan = materialize(goals.withColumn("budget", F.col("target") - F.col("rounds") * F.col("source_size")), "mix-plan")
    limits = thresholds(slim, plan.where("budget > 0"))
    bounds = materialize(
        plan.alias("p")
        .join(limits.alias("l"), F.col("p.source").eqNullSafe(F.col("l.source")), "left")
        .select("p.source", "p.source_size", "p.target", "p.rounds", F.coalesce("l.threshold", F.lit(0)).alias("threshold")),
        "mix-bounds",
    )
    copies = F.col("rounds") + (F.col("hash") < F.col("threshold")).cast("bigint")
    return (
        slim.alias("d")
        .join(bounds.alias("b"), F.col("d.source").eqNullSafe(F.col("b.source")))
        .select(
            "d.doc_id", "d.source", "d.hash", "d.size", "b.source_size", "b.target", copies.alias("copies"),
            (copies * F.col("d.size")).alias("taken"),
        )
    )


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` themselves, each as often as the mix takes it."""
    # One document may stand in two sources that are taken differently often.
    source = {"in_source": F.coalesce("source", F.lit("")), "no_source": F.col("source").isNull()}
    keys = {**id_keys(), **source}
    taken = mix(docs).where("copies > 0").select(*[c.alias(n) for n, c in keys.items()], "hash", "copies").distinct()
    both = packed(docs, **keys, hash=document_hash()).join(taken, [*keys, "hash"])
    return both.select("row", F.explode(F.sequence(F.lit(1).cast("bigint"), "copies"))).select("row.*")


SQL = """
WITH sized AS (
  SELECT doc_id, source,
    len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size,
    ('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || ' ' || md5(coalesce(text, ''))), 1, 12))::BIGINT AS hash
  FROM documents),
per_source AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
weighed AS (
  SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight FROM per_source),
shared AS (
  SELECT *, CAST(sum(source_size) OVER () AS BIGINT) - 3 * coalesce(CAST(sum(source_size) OVER w AS BIGINT), 0) AS rest,
    CAST(sum(weight) OVER () AS BIGINT) - coalesce(CAST(sum(weight) OVER w AS BIGINT), 0) AS rest_weight
  FROM weighed
  WINDOW w AS (ORDER BY source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
marked AS (SELECT *, 3 * source_size * rest_weight <= rest * weight AS capped FROM shared),
unit AS (SELECT rest, rest_weight FROM marked WHERE NOT capped ORDER BY source_size / weight, source NULLS LAST LIMIT 1),
goals AS (
  SELECT source, source_size, CASE WHEN capped THEN CAST(3 * source_size AS DOUBLE)
    ELSE (SELECT CAST(rest AS DOUBLE) / CAST(rest_weight AS DOUBLE) FROM unit) * CAST(weight AS DOUBLE) END AS target
  FROM marked),
plan AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS rounds FROM goals),
ranked AS (
  SELECT s.doc_id, s.size, s.hash, p.source_size, p.target, p.rounds, p.target - p.rounds * p.source_size AS budget,
    CAST(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.hash RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS upto,
    CAST(sum(s.size) OVER (PARTITION BY s.source, s.hash) AS BIGINT) AS tied
  FROM sized s JOIN plan p ON s.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
  CAST(size * (rounds + CASE WHEN budget > 0 AND (upto <= budget OR (upto - tied <= budget AND budget - (upto - tied) >= upto - budget))
    THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM ranked
"""
