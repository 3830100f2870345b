"""Flat JSON messages with epoch-millis publish times to tables with year and month."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.types import TimestampType

from metricloom.functions.casts import to_long
from metricloom.functions.dates import duration_seconds, publish_month, publish_year
from metricloom.operators.envelope import decode_value, parse_flat
from metricloom.schemas import DATED_MESSAGES, DATED_RENAMES
from metricloom.sources.tables import TableStore
from metricloom.sources.topics import Topic
from metricloom.streaming.runner import preview_stream, run_stream, stream_to_table


def with_publish_period(df: DataFrame, published: str = "published_at") -> DataFrame:
    """``df`` plus ``year`` and ``month`` of a column of epoch-millis texts or of instants."""
    millis = F.col(published)
    if isinstance(df.schema[published].dataType, TimestampType):
        millis = F.unix_millis(millis).cast("string")
    return df.select("*", publish_year(millis).alias("year"), publish_month(millis).alias("month"))


def dated(messages: DataFrame, entity: str) -> DataFrame:
    """The entity's columns with publish year and month; videos with their duration in
    seconds in place of its text."""
    rows = parse_flat(decode_value(messages), DATED_MESSAGES[entity], DATED_RENAMES.get(entity))
    if entity != "videos":
        return with_publish_period(rows)
    whole = rows.withColumn("view_count", to_long("view_count"))
    seconds = duration_seconds("duration").alias("duration_seconds")
    return with_publish_period(whole).select("*", seconds).drop("duration")


def run_dated(
    spark: SparkSession,
    entity: str,
    source: Topic,
    store: TableStore,
    checkpoint: str,
    name: str | None = None,
    every: str | None = None,
) -> StreamingQuery:
    target = name or f"{entity}_year_month"
    return run_stream(
        spark,
        source,
        lambda messages: dated(messages, entity),
        lambda rows: stream_to_table(rows, store, target, checkpoint, every),
    )


def preview_dated(spark: SparkSession, entity: str, source: Topic, **options: str) -> StreamingQuery:
    return run_stream(
        spark, source, lambda messages: dated(messages, entity), lambda rows: preview_stream(rows, **options)
    )


def run_dated_channels(spark: SparkSession, source: Topic, store: TableStore, **options: str) -> StreamingQuery:
    return run_dated(spark, "channels", source, store, **options)


def run_dated_playlists(spark: SparkSession, source: Topic, store: TableStore, **options: str) -> StreamingQuery:
    return run_dated(spark, "playlists", source, store, **options)


def run_dated_videos(spark: SparkSession, source: Topic, store: TableStore, **options: str) -> StreamingQuery:
    return run_dated(spark, "videos", source, store, **options)


def run_dated_comments(spark: SparkSession, source: Topic, store: TableStore, **options: str) -> StreamingQuery:
    return run_dated(spark, "comments", source, store, **options)
