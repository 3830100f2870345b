"""Enriched tables: title and text lengths in words, and network mentions."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from metricloom.functions.text import NETWORKS, keyword_counts, word_count
from metricloom.sources.tables import TableStore, read_table, write_table


def enrich_playlists(df: DataFrame) -> DataFrame:
    return df.select("*", word_count("playlist_title").alias("playlist_title_length"))


def enrich_videos(df: DataFrame, networks: Sequence[str] = NETWORKS) -> DataFrame:
    """A report over one network need not look for the others."""
    return keyword_counts(df, "video_description", networks)


def enrich_comments(df: DataFrame) -> DataFrame:
    return df.select("*", word_count("comment_text").alias("text_length"))


ENRICH: dict[str, Callable[[DataFrame], DataFrame]] = {
    "playlists": enrich_playlists,
    "videos": enrich_videos,
    "comments": enrich_comments,
}


def run_enrich(
    spark: SparkSession, entity: str, source: TableStore, sink: TableStore, name: str, target: str, mode: str = "errorifexists"
) -> None:
    """Read table ``name``, write the enriched table ``target``."""
    write_table(ENRICH[entity](read_table(spark, source, name)), sink, target, mode)


def run_enrich_playlists(spark: SparkSession, source: TableStore, sink: TableStore, **options: str) -> None:
    run_enrich(spark, "playlists", source, sink, **{"name": "playlists", "target": "playlists_enriched", **options})


def run_enrich_videos(spark: SparkSession, source: TableStore, sink: TableStore, **options: str) -> None:
    run_enrich(spark, "videos", source, sink, **{"name": "videos", "target": "videos_enriched", **options})


def run_enrich_comments(spark: SparkSession, source: TableStore, sink: TableStore, **options: str) -> None:
    run_enrich(spark, "comments", source, sink, **{"name": "comments", "target": "comments_enriched", **options})
