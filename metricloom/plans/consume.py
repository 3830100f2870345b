"""Flat JSON messages, enriched and sent on to a keyed topic."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming.query import StreamingQuery

from metricloom.operators.envelope import decode_value, parse_flat
from metricloom.plans.enrich import ENRICH
from metricloom.schemas import CONSUMER_MESSAGES, CONSUMER_RENAMES
from metricloom.sources.topics import Topic
from metricloom.streaming.runner import preview_stream, run_stream, stream_to_topic

# The column whose text keys the outgoing message.
MESSAGE_KEYS = {
    "channels": "channel_id",
    "playlists": "published_at",
    "videos": "published_at",
    "comments": "published_at",
}


def received(messages: DataFrame, entity: str) -> DataFrame:
    """Columns of the messages as they came."""
    return parse_flat(decode_value(messages), CONSUMER_MESSAGES[entity], CONSUMER_RENAMES.get(entity))


def consumed(messages: DataFrame, entity: str) -> DataFrame:
    """Columns of the messages with the lengths or mentions of the entity."""
    rows = received(messages, entity)
    return ENRICH[entity](rows) if entity in ENRICH else rows


def run_consume(
    spark: SparkSession, entity: str, source: Topic, sink: Topic, checkpoint: str, every: str | None = None
) -> StreamingQuery:
    return run_stream(
        spark,
        source,
        lambda messages: consumed(messages, entity),
        lambda rows: stream_to_topic(rows, sink, checkpoint, MESSAGE_KEYS[entity], every),
    )


def preview_consume(spark: SparkSession, entity: str, source: Topic, **options: str) -> StreamingQuery:
    """Show the messages as they came."""
    return run_stream(
        spark, source, lambda messages: received(messages, entity), lambda rows: preview_stream(rows, **options)
    )


def run_consume_channels(spark: SparkSession, source: Topic, sink: Topic, **options: str) -> StreamingQuery:
    return run_consume(spark, "channels", source, sink, **options)


def run_consume_playlists(spark: SparkSession, source: Topic, sink: Topic, **options: str) -> StreamingQuery:
    return run_consume(spark, "playlists", source, sink, **options)


def run_consume_videos(spark: SparkSession, source: Topic, sink: Topic, **options: str) -> StreamingQuery:
    return run_consume(spark, "videos", source, sink, **options)


def run_consume_comments(spark: SparkSession, source: Topic, sink: Topic, **options: str) -> StreamingQuery:
    return run_consume(spark, "comments", source, sink, **options)
