"""What comes between pulls of the platform's API and the reports: new keys, counted batches, appends that can be repeated, drifting
schemas, bucketed snapshots."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.errors import StreamingQueryException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from metricloom.operators.drift import schema_drift
from metricloom.operators.envelope import decode_value
from metricloom.schemas import struct_of
from metricloom.session import scratch_path
from metricloom.sources.bucketed import group_change, key_change, write_bucketed
from metricloom.sources.tables import TableStore, read_table, write_table
from metricloom.sources.topics import IDENTITY, Topic, publish, read_identified, read_stream
from metricloom.streaming.counts import stream_with_counts
from metricloom.streaming.ledger import append_rows, stream_to_store
from metricloom.streaming.new_keys import stream_new_keys
from metricloom.workload.bindings import BOUND, BOUND_SQL, comments
from metricloom.workload.documents import EVENT_MESSAGE, event_messages
from metricloom.workload.registry import Query
from metricloom.workload.reports import QUERIES as REPORT_QUERIES
from metricloom.workload.reports import SNAPSHOTS_SQL, snapshots
from metricloom.workload.streams import new_topic

PARTS = 3


def new_keys_comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Authors per video as three pulls bring them, each with the pull that met it first."""
    store, checkpoint = TableStore(scratch_path(spark, "store")), scratch_path(spark, "checkpoint")
    rows = BOUND["comments"](spark, sf_dir)
    for part in range(PARTS):
        write_table(rows.where(F.col("comment_like_count") % PARTS == part), store, "comments", "append")
        stream_new_keys(spark, store, "comments", "comment_author_channel_id", "new", checkpoint, "video_id")
    return read_table(spark, store, "new").select("video_id", "comment_author_channel_id", F.col("batch_id").alias("pull"))


def _messages(df: DataFrame) -> DataFrame:
    return df.select(F.lit(None).cast("string").alias("key"), F.col("value").cast("binary").alias("value"))


def counts_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages, messages without a key and unreadable messages of three batches, and the rows that were written."""
    topic, store, checkpoint = new_topic(spark, "in-events"), TableStore(scratch_path(spark, "store")), scratch_path(spark, "checkpoint")
    for part in range(PARTS):
        _messages(event_messages(spark, sf_dir).where(F.col("event_id") % PARTS == part)).write.mode("append").parquet(topic.name)
        stream_with_counts(decode_value(read_stream(spark, topic)), EVENT_MESSAGE, "event_id", store, "events", "counts", checkpoint)
    written = read_table(spark, store, "events").groupBy("batch_id").agg(F.count(F.lit(1)).alias("written_count"))
    return read_table(spark, store, "counts").drop("query_id").join(written, "batch_id")


def ledger_comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Comments appended to a table batch by batch; each batch's first write is lost after half of its messages."""
    topic, store, checkpoint = scratch_path(spark, "in-comments"), TableStore(scratch_path(spark, "store")), scratch_path(spark, "checkpoint")
    message = {"comment_id": "string", "comment_like_count": "int"}
    publish(comments(spark, sf_dir).select(*message).repartition(PARTS, "comment_id"), Topic(topic))
    failed = set()

    def lost_half_way(rows: DataFrame, to: TableStore, name: str) -> None:
        batch = rows.select("batch_id").first()
        if batch is not None and batch[0] not in failed:
            failed.add(batch[0])
            append_rows(rows.where(F.pmod(F.xxhash64(*IDENTITY), F.lit(2)) == 0), to, name)
            raise RuntimeError("lost half-way")
        append_rows(rows, to, name)

    while True:
        source = read_identified(spark, Topic(topic, options={"maxFilesPerTrigger": "1"}))
        parsed = source.select(F.from_json(F.col("value").cast("string"), struct_of(message)).alias("m"), *IDENTITY).select("m.*", *IDENTITY)
        try:
            stream_to_store(parsed, store, "comments", checkpoint, append=lost_half_way)
            break
        except StreamingQueryException as e:
            if "lost half-way" not in str(e):
                raise
    rows = read_table(spark, store, "comments")
    return rows.select("comment_id", "comment_like_count", F.lit(len(failed) > 0).alias("was_repeated"))


def drift_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields of the damaged messages of all events against a schema that declares one more."""
    return schema_drift(event_messages(spark, sf_dir).select("value"), {**EVENT_MESSAGE, "session": "string"})


def _damaged_item() -> Column:
    """Items of channels, some with a count as a number, some with a field that nobody declared and some with a title that is a number."""
    number, counts = F.col("subscriber_count"), F.col("view_count")
    whole = F.to_json(F.struct(F.col("channel_id").alias("id"), F.struct(F.col("channel_title").alias("title")).alias("snippet"), F.struct(counts.cast("string").alias("viewCount")).alias("statistics")))
    retyped = F.to_json(F.struct(F.col("channel_id").alias("id"), F.struct(number.alias("title")).alias("snippet"), F.struct(counts.alias("viewCount")).alias("statistics")))
    unknown = F.to_json(F.struct(F.col("channel_id").alias("id"), F.struct(F.lit(True).alias("isNew"), F.array(F.lit(1)).alias("tags")).alias("snippet"), F.lit(0.5).alias("share")))
    part = F.col("channel_id").cast("bigint") % 5
    return F.when(part == 0, retyped).when(part == 1, unknown).when(part == 2, F.lit('{"id": "x", "snippet": "none"}')).otherwise(whole)


CHANNEL_MESSAGE = "id string, snippet struct<title: string, country: string>, statistics struct<viewCount: string>"


def drift_channels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested items of channels, three in five damaged, against their schema."""
    schema = spark.createDataFrame([], CHANNEL_MESSAGE).schema
    return schema_drift(BOUND["channels"](spark, sf_dir).select(_damaged_item().alias("value")), schema)


DRIFT_CHANNELS = (  # field, kind, status, parts of five that hold it
    ("id", "text", "expected", (0, 1, 2, 3, 4)),
    ("snippet", "object", "expected", (0, 1, 3, 4)),
    ("snippet", "text", "retyped", (2,)),
    ("snippet.title", "text", "expected", (3, 4)),
    ("snippet.title", "whole", "retyped", (0,)),
    ("snippet.isNew", "flag", "unknown", (1,)),
    ("snippet.tags", "array", "unknown", (1,)),
    ("share", "number", "unknown", (1,)),
    ("statistics", "object", "expected", (0, 3, 4)),
    ("statistics.viewCount", "text", "expected", (3, 4)),
    ("statistics.viewCount", "whole", "retyped", (0,)),
)


def drift_channels_sql() -> str:
    parts = [
        f"SELECT '{field}' AS field, '{kind}' AS kind, count(*) AS message_count, '{status}' AS status FROM bound WHERE part IN ({', '.join(map(str, which))}) HAVING count(*) > 0"
        for field, kind, status, which in DRIFT_CHANNELS
    ]
    return reduce(
        lambda a, b: f"{a} UNION ALL {b}",
        parts,
        f"WITH bound AS (SELECT CAST(channel_id AS BIGINT) % 5 AS part FROM ({BOUND_SQL['channels']}) AS b) SELECT 'snippet.country' AS field, NULL AS kind, 0 AS message_count, 'absent' AS status",
    )


def _bucketed(spark: SparkSession, sf_dir: str) -> str:
    rows, store = snapshots(spark, sf_dir), TableStore(scratch_path(spark, "store"))
    return write_bucketed(rows, store, "channels", "id", ["country"], "view_count", 8, f"channels_{uuid.uuid4().hex}")


def bucketed_change_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily change of views per country from snapshots that lie in buckets."""
    changed = group_change(spark, _bucketed(spark, sf_dir), ["country"], "view_count")
    return changed.withColumn("snapshot_date", F.col("snapshot_date").cast("string"))


def bucketed_change_channels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily change of views of each channel, without a shuffle."""
    changed = key_change(spark, _bucketed(spark, sf_dir), "id", "view_count")
    return changed.withColumn("snapshot_date", F.col("snapshot_date").cast("string"))


QUERIES: dict[str, Query] = {
    "stream_new_keys_comments": Query(
        new_keys_comments,
        f"""SELECT video_id, comment_author_channel_id, CAST(min(comment_like_count % {PARTS}) AS BIGINT) AS pull
            FROM ({BOUND_SQL['comments']}) AS bound WHERE comment_author_channel_id IS NOT NULL GROUP BY 1, 2""",
    ),
    "stream_counts_events": Query(
        counts_events,
        f"""SELECT event_id % {PARTS} AS batch_id, count(*) AS row_count, count(*) FILTER (event_id % 10 IN (0, 2, 3)) AS null_key_count,
              count(*) FILTER (event_id % 10 < 4) AS reject_count, count(*) FILTER (event_id % 10 > 3) AS written_count
            FROM events GROUP BY 1""",
    ),
    "stream_ledger_comments": Query(
        ledger_comments, f"SELECT comment_id, comment_like_count, true AS was_repeated FROM ({BOUND_SQL['comments']}) AS bound"
    ),
    "schema_drift_events": Query(
        drift_events,
        """SELECT 'event_id' AS field, 'whole' AS kind, count(*) AS message_count, 'expected' AS status FROM events WHERE event_id % 10 NOT IN (0, 2, 3)
           UNION ALL SELECT 'k', 'text', count(*), 'retyped' FROM events WHERE event_id % 10 = 1
           UNION ALL SELECT 'k', 'whole', count(*), 'expected' FROM events WHERE event_id % 10 > 3
           UNION ALL SELECT 'session', NULL, 0, 'absent'""",
    ),
    "schema_drift_channels": Query(drift_channels, drift_channels_sql()),
    "pct_change_bucketed_country": Query(bucketed_change_country, REPORT_QUERIES["pct_change_country"].sql),
    "pct_change_bucketed_channels": Query(
        bucketed_change_channels,
        f"""WITH s AS ({SNAPSHOTS_SQL}), d AS (
              SELECT id, CAST(ts AS DATE) AS day, view_count, row_number() OVER (PARTITION BY id, CAST(ts AS DATE) ORDER BY ts DESC, view_count DESC) AS n FROM s)
            SELECT id, CAST(day AS VARCHAR) AS snapshot_date, view_count,
              CAST((view_count - lag(view_count) OVER w) * 100 AS DOUBLE) / nullif(lag(view_count) OVER w, 0) AS percent_change
            FROM d WHERE n = 1 WINDOW w AS (PARTITION BY id ORDER BY day)""",
    ),
}
