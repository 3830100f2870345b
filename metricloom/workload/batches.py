"""What surrounds the batches of streams: the landing tree, packed tables, dead letters, repeated batches and previews."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from metricloom.functions.casts import document_instant
from metricloom.operators.envelope import decode_value, nested_item, parse_flat, project_fields
from metricloom.plans.cleanse import LANDING_GLOBS, run_cleanse
from metricloom.plans.dated import run_dated
from metricloom.plans.enrich import ENRICH
from metricloom.plans.snapshot import run_snapshot
from metricloom.schemas import DATED_MESSAGES, ITEM_FIELDS
from metricloom.session import scratch_path
from metricloom.sources import files
from metricloom.sources.landing_tree import land_tree, read_tree
from metricloom.sources.tables import TableStore, read_table
from metricloom.sources.topics import Topic, publish, read_stream
from metricloom.streaming.compaction import compact, read_compacted, vacuum
from metricloom.streaming.dead_letters import stream_with_rejects
from metricloom.streaming.runner import preview_stream, run_stream, stream_to_table
from metricloom.workload.bindings import BOUND, BOUND_SQL, PERIOD_SQL, as_epoch_text, channels, columns_sql, show_times
from metricloom.workload.documents import EVENT_MESSAGE, event_messages
from metricloom.workload.registry import Query
from metricloom.workload.scalars import SNAPSHOT_TIME
from metricloom.workload.streams import QUERIES as STREAMS
from metricloom.workload.streams import new_topic, snapshot_types

PREVIEWED = 20


def landing_tree_comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Comments landed below their channel and video, and read back with the keys of their folders."""
    df, path = BOUND["comments"](spark, sf_dir), scratch_path(spark, "tree")
    channel = F.concat(F.lit("_c/"), (F.col("video_id").cast("bigint") % 20).cast("string"))
    land_tree(df, path, "comments", {"channel_id": channel, "video_id": F.col("video_id")}, nested_item(df, "comments"), "comment_id")
    keys = ["folder_channel_id", "folder_video_id"]
    items = read_tree(spark, path, "comments").select(*keys, F.explode("items").alias("item"))
    return show_times(project_fields(items, ITEM_FIELDS["comments"], "item", keys, document_instant))


def landing_tree_playlists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Playlists landed below their channel in pages, twice so that pages of the first time must go, and cleansed from the tree."""
    df, path, store = BOUND["playlists"](spark, sf_dir), scratch_path(spark, "tree"), TableStore(scratch_path(spark, "store"))
    for page_bytes in (2_000, 20_000):
        land_tree(df, path, "playlists", {"channel_id": F.col("channel_id")}, nested_item(df, "playlists"), "playlist_id", page_bytes)
    run_cleanse(spark, "playlists", f"{path}/{LANDING_GLOBS['playlists']}", store, "playlists")
    return show_times(read_table(spark, store, "playlists"))


def compacted_comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dated comments of many batches, packed and cleared of the batches that were packed."""
    topic, store = scratch_path(spark, "in-comments"), TableStore(scratch_path(spark, "store"))
    df = as_epoch_text(ENRICH["comments"](BOUND["comments"](spark, sf_dir))).select(*DATED_MESSAGES["comments"])
    publish(df.repartition(6, "comment_id"), Topic(topic))
    source = Topic(topic, options={"maxFilesPerTrigger": "1"})
    run_dated(spark, "comments", source, store, scratch_path(spark, "checkpoint"), name="comments")
    path = store.path("comments")
    version = compact(spark, path)
    removed = vacuum(spark, path)
    return read_compacted(spark, path).select("comment_id", "year", "month", F.lit(removed > 1 and len(version.packed) == 1).alias("packed"))


def dead_letters_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages of events, four in ten of which cannot be read, to a table each; the last batch is run twice."""
    source, store, checkpoint = new_topic(spark, "in-events"), TableStore(scratch_path(spark, "store")), scratch_path(spark, "checkpoint")
    event_messages(spark, sf_dir).select(F.lit(None).cast("string").alias("key"), F.col("value").cast("binary").alias("value")).write.parquet(source.name)
    for _ in range(2):
        stream_with_rejects(decode_value(read_stream(spark, source)), EVENT_MESSAGE, store, "events", "rejected", checkpoint)
        forget_last_commit(spark, checkpoint)
    good, rejected = read_table(spark, store, "events"), read_table(spark, store, "rejected")
    return good.select(F.col("event_id").cast("string").alias("event"), F.col("k").cast("double").alias("k"), F.lit("good").alias("kind")).unionByName(
        rejected.select(F.coalesce("value", F.lit("none")).alias("event"), F.lit(None).cast("double").alias("k"), F.col("reason").alias("kind"))
    )


def forget_last_commit(spark: SparkSession, checkpoint: str) -> None:
    """Leave a checkpoint as a driver that is lost between a batch's write and its commit leaves it."""
    done = [n for n in files.names(spark, f"{checkpoint}/commits") if n.isdigit()]
    if done:
        last = max(done, key=int)
        files.delete(spark, f"{checkpoint}/commits/.{last}.crc")
        files.delete(spark, f"{checkpoint}/commits/{last}")


def replayed_channels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two chained streams; the first one's batch is repeated after the second has read it."""
    source, between, store = new_topic(spark, "in-channels"), new_topic(spark, "snapshots"), TableStore(scratch_path(spark, "store"))
    df = channels(spark, sf_dir)
    publish(df.select(nested_item(df, "channels").alias("item")).select("item.*"), source)
    first, second, message = scratch_path(spark, "checkpoint"), scratch_path(spark, "checkpoint"), snapshot_types("channels")
    for _ in range(2):
        run_snapshot(spark, "channels", source, between, first, at=SNAPSHOT_TIME)
        to_table = lambda sdf: stream_to_table(sdf, store, "channels", second)
        run_stream(spark, between, lambda sdf: parse_flat(decode_value(sdf), message), to_table)
        forget_last_commit(spark, first)
    return show_times(read_table(spark, store, "channels").drop("query_id", "batch_id"), "published_at", "current_time")


def preview_channels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many rows a preview of a stream shows, and how many of them the table has."""
    source, view = new_topic(spark, "in-channels"), f"preview_{uuid.uuid4().hex}"
    rows = channels(spark, sf_dir).select("channel_id", "view_count")
    publish(rows, source)
    sdf = parse_flat(decode_value(read_stream(spark, source)), {"channel_id": "string", "view_count": "bigint"})
    preview_stream(sdf.limit(PREVIEWED), memory=view)
    shown = spark.table(view)
    known = shown.join(rows, ["channel_id", "view_count"], "left_semi").agg(F.count(F.lit(1)).alias("known_count"))
    return known.select("known_count", F.lit(shown.count()).cast("bigint").alias("row_count"))


QUERIES: dict[str, Query] = {
    "landing_tree_comments": Query(
        landing_tree_comments,
        f"""SELECT {columns_sql('comments')}, '_c/' || CAST(CAST(video_id AS BIGINT) % 20 AS VARCHAR) AS folder_channel_id, video_id AS folder_video_id
            FROM ({BOUND_SQL['comments']}) AS bound""",
    ),
    "landing_tree_playlists": Query(landing_tree_playlists, f"SELECT {columns_sql('playlists')} FROM ({BOUND_SQL['playlists']}) AS bound"),
    "stream_compacted_comments": Query(
        compacted_comments, f"SELECT comment_id, {PERIOD_SQL}, true AS packed FROM ({BOUND_SQL['comments']}) AS bound"
    ),
    "stream_dead_letters_events": Query(
        dead_letters_events,
        """WITH m AS (SELECT event_id, props, event_id % 10 AS r, '{"event_id": ' || CAST(event_id AS VARCHAR) AS head FROM events)
           SELECT CASE r WHEN 0 THEN rtrim(head || ', ' || substr(props, 2), '}') WHEN 1 THEN head || ', "k": "many"}' WHEN 2 THEN ''
                    WHEN 3 THEN 'none' ELSE CAST(event_id AS VARCHAR) END AS event,
             CASE WHEN r > 3 THEN CAST(regexp_extract(props, '[0-9]+') AS DOUBLE) END AS k,
             CASE r WHEN 0 THEN 'broken' WHEN 1 THEN 'misfit' WHEN 2 THEN 'empty' WHEN 3 THEN 'empty' ELSE 'good' END AS kind
           FROM m""",
    ),
    "stream_replayed_channels": Query(replayed_channels, STREAMS["stream_chained_channels"].sql),
    "stream_preview_channels": Query(
        preview_channels, f"SELECT least(count(*), {PREVIEWED}) AS known_count, least(count(*), {PREVIEWED}) AS row_count FROM customer"
    ),
}
