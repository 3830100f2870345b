"""Landed API documents to the four cleansed tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from metricloom.functions.lookup import with_category
from metricloom.operators.envelope import flatten_envelope
from metricloom.operators.quality import quality_columns
from metricloom.schemas import CORRUPT, KEYS, TABLE_COLUMNS
from metricloom.sources.landing import read_documents
from metricloom.sources.tables import TableStore, write_table

# Where the documents of each entity lie under the landing folder.
LANDING_GLOBS = {
    "channels": "channels/*/statistics/*",
    "playlists": "channels/*/playlists/*",
    "videos": "channels/*/videos/*/statistics",
    "comments": "channels/*/videos/*/content",
}


def cleanse(envelopes: DataFrame, entity: str) -> DataFrame:
    """Typed table rows of an entity in their fixed column order."""
    rows = flatten_envelope(envelopes, entity)
    if entity == "videos":
        rows = with_category(rows)
    return rows.select(*TABLE_COLUMNS[entity])


def run_cleanse(
    spark: SparkSession, entity: str, landing: str, store: TableStore, name: str, mode: str = "errorifexists"
) -> dict[str, int]:
    """Cleanse what lies at ``landing`` (a folder or glob) into a table.

    Returns the quality counts: documents, broken documents (their readable items are kept),
    rows, and rows without a key. They are observed while the table is written; the files
    are read once.
    """
    documents, rows = Observation(f"{entity}-documents"), Observation(f"{entity}-rows")
    read = read_documents(spark, landing, entity).observe(
        documents,
        F.count(F.lit(1)).alias("document_count"),
        F.count(CORRUPT).alias("broken_document_count"),
    )
    table = cleanse(read, entity).observe(rows, *quality_columns(KEYS[entity]))
    write_table(table, store, name, mode)
    return {**documents.get, **rows.get}


def run_cleanse_channels(spark: SparkSession, landing: str, store: TableStore, **options: str) -> dict[str, int]:
    return run_cleanse(spark, "channels", landing, store, **{"name": "channels", **options})


def run_cleanse_playlists(spark: SparkSession, landing: str, store: TableStore, **options: str) -> dict[str, int]:
    return run_cleanse(spark, "playlists", landing, store, **{"name": "playlists", **options})


def run_cleanse_videos(spark: SparkSession, landing: str, store: TableStore, **options: str) -> dict[str, int]:
    return run_cleanse(spark, "videos", landing, store, **{"name": "videos", **options})


def run_cleanse_comments(spark: SparkSession, landing: str, store: TableStore, **options: str) -> dict[str, int]:
    return run_cleanse(spark, "comments", landing, store, **{"name": "comments", **options})
