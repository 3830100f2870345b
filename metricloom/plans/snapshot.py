"""Nested JSON messages as timed snapshots, sent on to a topic without a key."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming.query import StreamingQuery

from metricloom.functions.dates import utc_day, with_snapshot_time
from metricloom.functions.lookup import with_category
from metricloom.operators.envelope import decode_value, parse_nested
from metricloom.plans.enrich import enrich_comments, enrich_playlists
from metricloom.schemas import SNAPSHOT_COLUMNS
from metricloom.sources.tables import TableStore
from metricloom.sources.topics import Topic
from metricloom.streaming.runner import preview_stream, run_stream, stream_to_table, stream_to_topic

# The made-for-kids flag is part of the landed documents but not of these messages.
NOT_IN_MESSAGES = ("made_for_kids",)


def snapshot(messages: DataFrame, entity: str, at: datetime | str | None = None) -> DataFrame:
    """``current_time`` and the entity's columns; titles and comments with their lengths."""
    rows = parse_nested(decode_value(messages), entity, NOT_IN_MESSAGES)
    if entity == "videos":
        rows = with_category(rows, spaced=True)
    rows = rows.select(*SNAPSHOT_COLUMNS[entity])
    if entity == "playlists":
        rows = enrich_playlists(rows)
    elif entity == "comments":
        rows = enrich_comments(rows)
    return with_snapshot_time(rows, at)


def run_snapshot(
    spark: SparkSession,
    entity: str,
    source: Topic,
    sink: Topic,
    checkpoint: str,
    every: str | None = None,
    at: datetime | str | None = None,
) -> StreamingQuery:
    return run_stream(
        spark,
        source,
        lambda messages: snapshot(messages, entity, at),
        lambda rows: stream_to_topic(rows, sink, checkpoint, every=every),
    )


def run_snapshot_table(
    spark: SparkSession,
    entity: str,
    source: Topic,
    store: TableStore,
    checkpoint: str,
    name: str | None = None,
    every: str | None = None,
    at: datetime | str | None = None,
) -> StreamingQuery:
    """Keep the snapshots in one table partitioned by their UTC day.

    A batch that is repeated after a failure keeps its time, so it returns to the same day.
    """
    return run_stream(
        spark,
        source,
        lambda messages: snapshot(messages, entity, at).withColumn("snapshot_date", utc_day("current_time")),
        lambda rows: stream_to_table(rows, store, name or f"{entity}_snapshots", checkpoint, every, ("snapshot_date",)),
    )


def preview_snapshot(spark: SparkSession, entity: str, source: Topic, **options: str) -> StreamingQuery:
    return run_stream(
        spark, source, lambda messages: snapshot(messages, entity), lambda rows: preview_stream(rows, **options)
    )


def run_snapshot_channels(spark: SparkSession, source: Topic, sink: Topic, **options: str) -> StreamingQuery:
    return run_snapshot(spark, "channels", source, sink, **options)


def run_snapshot_playlists(spark: SparkSession, source: Topic, sink: Topic, **options: str) -> StreamingQuery:
    return run_snapshot(spark, "playlists", source, sink, **options)


def run_snapshot_videos(spark: SparkSession, source: Topic, sink: Topic, **options: str) -> StreamingQuery:
    return run_snapshot(spark, "videos", source, sink, **options)


def run_snapshot_comments(spark: SparkSession, source: Topic, sink: Topic, **options: str) -> StreamingQuery:
    return run_snapshot(spark, "comments", source, sink, **options)
