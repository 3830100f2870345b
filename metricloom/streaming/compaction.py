"""Compaction of folders that streams fill batch by batch.

A stream into a folder makes a partition of small files per batch. Compaction packs the batches that are closed into files
of a good size beside them, and says so in a new version of the manifest:

    <table>/query_id=<q>/batch_id=<n>/   batches as streams write them
    <table>/_packed/<version>-<id>/      packed rows; Spark's listings pass over the name
    <table>/_manifests/<version>.json    which packed folders count, and up to which batch of each query they reach

A reader takes one version: its packed folders, and the batches after those it names. So it sees a batch as it was written
or packed, never both, and a version stays readable until ``vacuum`` removes what it alone needs. The newest batch of a query
is the only one that can be written again after a failure; it is never packed, so it still replaces itself.

Packing does not shuffle: a scan that puts small files together up to the target size gives one file per task. Only a
table partitioned by columns of its own is dealt by those. Packed folders that are still small are packed again next to what is new.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from metricloom.sources import files

TARGET_BYTES = 256 * 1024 * 1024
MARKS = ["query_id", "batch_id"]


@dataclass(frozen=True)
class Version:
    """``packed`` maps folders below the table to their bytes; ``upto`` maps queries to their last packed batch."""

    number: int = 0
    packed: dict[str, int] = field(default_factory=dict)
    upto: dict[str, int] = field(default_factory=dict)


def versions(spark: SparkSession, path: str) -> list[Version]:
    """All whole manifests, oldest first. One that a lost driver left unfinished does not count."""
    found = []
    for name in files.names(spark, f"{path}/_manifests"):
        if not name.endswith(".json"):
            continue
        try:
            read = json.loads(files.read_text(spark, f"{path}/_manifests/{name}"))
        except json.JSONDecodeError:
            continue
        found.append(Version(read["number"], read["packed"], read["upto"]))
    return sorted(found, key=lambda v: v.number)


def current(spark: SparkSession, path: str) -> Version:
    return (versions(spark, path) or [Version()])[-1]


def _batches(spark: SparkSession, path: str) -> DataFrame:
    """The batches as streams wrote them, their marks typed."""
    rows = spark.read.parquet(path)
    return rows.withColumns({"query_id": F.col("query_id").cast("string"), "batch_id": F.col("batch_id").cast("bigint")})


def _packed_upto(upto: dict[str, int]) -> Column:
    """The last packed batch of a row's query, -1 if none."""
    if not upto:
        return F.lit(-1).cast("bigint")
    known = F.create_map(*[F.lit(x).cast("bigint") if i % 2 else F.lit(x) for pair in upto.items() for i, x in enumerate(pair)])
    return F.coalesce(F.try_element_at(known, F.col("query_id")), F.lit(-1).cast("bigint"))


def read_compacted(spark: SparkSession, path: str, version: Version | None = None) -> DataFrame:
    """The table as a version tells it, the current one by default."""
    version = version or current(spark, path)
    rows = _batches(spark, path).where(F.col("batch_id") > _packed_upto(version.upto))
    for folder in version.packed:
        rows = rows.unionByName(spark.read.parquet(f"{path}/{folder}").select(*rows.columns))
    return rows


def _packing_session(spark: SparkSession, target_bytes: int) -> SparkSession:
    """A session whose scans fill their tasks up to the target with whole small files."""
    session = spark.newSession()
    session.conf.set("spark.sql.files.maxPartitionBytes", target_bytes)
    session.conf.set("spark.sql.files.openCostInBytes", 0)
    session.conf.set("spark.sql.files.minPartitionNum", 1)
    session.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", target_bytes)
    return session


def compact(spark: SparkSession, path: str, target_bytes: int = TARGET_BYTES, partition_by: Sequence[str] = ()) -> Version:
    """Pack the closed batches of a table and publish a new version; the current one if there is nothing to pack.

    Two compactions at a time do no harm: the version number is taken by whoever writes the manifest first, and the other
    one fails and leaves a packed folder that no version names.
    """
    before = current(spark, path)
    file = F.struct(F.col("_metadata.file_path"), F.col("_metadata.file_size"))
    listed = spark.read.parquet(path).select(F.col("query_id").cast("string"), F.col("batch_id").cast("bigint"), file.alias("file")).distinct()
    sizes = listed.groupBy(*MARKS).agg(F.sum("file.file_size").alias("bytes"))
    # One row per query: its newest batch stays as it is.
    closed = {r["query_id"]: r["newest"] - 1 for r in sizes.groupBy("query_id").agg(F.max("batch_id").alias("newest")).collect()}
    upto = before.upto | {q: n for q, n in closed.items() if n > before.upto.get(q, -1)}
    if upto == before.upto:
        return before
    kept = {folder: size for folder, size in before.packed.items() if size >= target_bytes // 2}
    session = _packing_session(spark, target_bytes)
    rows = _batches(session, path).where((F.col("batch_id") > _packed_upto(before.upto)) & (F.col("batch_id") <= _packed_upto(upto)))
    for folder in before.packed.keys() - kept.keys():
        rows = rows.unionByName(session.read.parquet(f"{path}/{folder}").select(*rows.columns))
    number = before.number + 1
    folder = f"_packed/{number:09d}-{uuid.uuid4().hex}"
    writer = (rows.hint("rebalance", *partition_by) if partition_by else rows).write
    writer.partitionBy(*partition_by).parquet(f"{path}/{folder}")
    size = session.read.parquet(f"{path}/{folder}").select(file.alias("file")).distinct().agg(F.sum("file.file_size")).first()[0]
    packed = kept | {folder: size or 0}
    version = Version(number, packed, upto)
    files.write_new(spark, f"{path}/_manifests/{number:09d}.json", json.dumps({"number": number, "packed": packed, "upto": upto}))
    return version


def vacuum(spark: SparkSession, path: str, keep: int = 1) -> int:
    """Remove what the last ``keep`` versions do not need; returns the number of folders removed.

    Readers of older versions must have ended.
    """
    known = versions(spark, path)
    kept = known[-max(keep, 1) :]
    if not kept:
        return 0
    oldest, named = kept[0], {folder for v in kept for folder in v.packed}
    listed = spark.read.parquet(path).select(F.col("query_id").cast("string"), F.col("batch_id").cast("bigint"), F.regexp_extract("_metadata.file_path", "^(.*)/[^/]+$", 1).alias("folder"))
    covered = listed.where(F.col("batch_id") <= _packed_upto(oldest.upto)).select("folder").distinct()
    removed = [r["folder"] for r in covered.toLocalIterator()]
    # Folders between a packed one's making and its manifest belong to a compaction that may still run.
    removed += [f"{path}/_packed/{n}" for n in files.names(spark, f"{path}/_packed") if f"_packed/{n}" not in named and int(n.split("-")[0]) < kept[-1].number]
    for folder in removed:
        files.delete(spark, folder)
    for version in known[: -len(kept)]:
        files.delete(spark, f"{path}/_manifests/{version.number:09d}.json")
    return len(removed)
