"""Connected components of an edge table, by rounds of contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metricloom.session import materialize


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges`` (``a``, ``b``, both bigint); a component's nodes share a root.

    Each round maps a node to the smallest of itself and its neighbours, in an order that a new hash draws, and
    replaces the edges by those between the images; in such an order a constant part of the nodes goes each round
    whatever the graph. Rounds are written to the shared folder. A node of very many edges is reduced before its
    shuffle, and joins on it are split by the adaptive planner.
    """
    between = materialize(edges.where("a <> b").select("a", "b").distinct(), "components-edges")
    maps: list[DataFrame] = []
    while not between.isEmpty():
        seed = F.lit(len(maps))
        both = between.unionByName(between.select(F.col("b").alias("a"), F.col("a").alias("b")))
        drawn = F.struct(F.xxhash64("b", seed).alias("draw"), F.col("b").alias("to"))
        nearest = both.groupBy("a").agg(F.min(drawn).alias("m"))
        own = F.struct(F.xxhash64("a", seed).alias("draw"), F.col("a").alias("to"))
        step = materialize(nearest.select(F.col("a").alias("node"), F.least("m", own)["to"].alias("to")), "components-map")
        maps.append(step)
        left = between.join(step.select(F.col("node").alias("a"), F.col("to").alias("a_to")), "a")
        right = left.join(step.select(F.col("node").alias("b"), F.col("to").alias("b_to")), "b")
        between = materialize(
            right.where("a_to <> b_to")
            .select(F.least("a_to", "b_to").alias("a"), F.greatest("a_to", "b_to").alias("b"))
            .distinct(),
            "components-edges",
        )
    if not maps:
        return between.select(F.col("a").alias("node"), F.col("b").alias("root"))
    roots = maps[0].select("node", F.col("to").alias("root"))
    for step in maps[1:]:
        onward = step.select(F.col("node").alias("root"), "to")
        roots = roots.join(onward, "root", "left").select("node", F.coalesce("to", "root").alias("root"))
    return materialize(roots, "components-roots")
