"""The streaming jobs over messages made from the bound tables.

Each query publishes the whole table as messages, runs the stream until it has read them
all, and returns what the sink holds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from metricloom.functions.text import NETWORKS
from metricloom.operators.envelope import decode_value, nested_item, parse_flat
from metricloom.plans.consume import MESSAGE_KEYS, run_consume
from metricloom.plans.dated import run_dated
from metricloom.plans.enrich import ENRICH
from metricloom.plans.reports import report
from metricloom.plans.snapshot import run_snapshot, run_snapshot_table
from metricloom.schemas import (
    CONSUMER_MESSAGES,
    CONSUMER_RENAMES,
    DATED_MESSAGES,
    DATED_RENAMES,
    ENTITIES,
    ITEM_FIELDS,
    SNAPSHOT_COLUMNS,
    struct_of,
)
from metricloom.session import scratch_path
from metricloom.sources.tables import TableStore, read_table
from metricloom.sources.topics import Topic, publish, read_topic
from metricloom.streaming.runner import run_stream, stream_to_table
from metricloom.workload.bindings import (
    BOUND,
    BOUND_SQL,
    LENGTHS_SQL,
    PERIOD_SQL,
    as_epoch_text,
    channels,
    category_sql,
    columns_sql,
    duration_sql,
    show_times,
    shown,
)
from metricloom.workload.registry import Query
from metricloom.workload.scalars import SNAPSHOT_MS, SNAPSHOT_TIME

# Columns that a stage adds, as they are read back from JSON.
ADDED: dict[str, dict[str, str]] = {
    "channels": {},
    "playlists": {"playlist_title_length": "int"},
    "videos": {f"{network}_count": "int" for network in NETWORKS},
    "comments": {"text_length": "int"},
}


def new_topic(spark: SparkSession, label: str) -> Topic:
    return Topic(scratch_path(spark, label))


def _read_topic(spark: SparkSession, topic: Topic, columns: dict[str, str]) -> DataFrame:
    parsed = read_topic(spark, topic).select("key", F.from_json(F.col("value").cast("string"), struct_of(columns)).alias("m"))
    return parsed.select("key", "m.*")


def _consume(entity: str) -> Query:
    message, renames = CONSUMER_MESSAGES[entity], CONSUMER_RENAMES.get(entity, {})
    received = {renames.get(c, c): kind for c, kind in message.items()}
    columns, by_time = tuple(received), MESSAGE_KEYS[entity] == "published_at"

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        source, sink = new_topic(spark, f"in-{entity}"), new_topic(spark, f"out-{entity}")
        back = {new: old for old, new in renames.items()}
        publish(BOUND[entity](spark, sf_dir).select(*columns).withColumnsRenamed(back), source)
        run_consume(spark, entity, source, sink, scratch_path(spark, "checkpoint"))
        rows = _read_topic(spark, sink, received | ADDED[entity])
        text = F.col("key").cast("string")
        # The text of a time follows the session's zone, so it is shown as the instant that it names there.
        keyed = rows.withColumn("message_key", F.unix_millis(text.cast("timestamp")) if by_time else text).drop("key")
        return show_times(keyed) if "published_at" in columns else keyed

    extra = f", {LENGTHS_SQL[entity]}" if entity in ENRICH else ""
    key = f"{'epoch_ms' if by_time else ''}({MESSAGE_KEYS[entity]}) AS message_key"
    sql = f"SELECT {columns_sql(entity, columns)}{extra}, {key} FROM ({BOUND_SQL[entity]}) AS bound"
    return Query(run, sql)


def snapshot_types(entity: str) -> dict[str, str]:
    becomes = {f.name: f.becomes for f in ITEM_FIELDS[entity]} | {"category": "string"}
    added = ADDED[entity] if entity != "videos" else {}
    return {"current_time": "timestamp"} | {c: becomes[c] for c in SNAPSHOT_COLUMNS[entity]} | added


def _snapshot(entity: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        source, sink = new_topic(spark, f"in-{entity}"), new_topic(spark, f"out-{entity}")
        df = BOUND[entity](spark, sf_dir)
        publish(df.select(nested_item(df, entity).alias("item")).select("item.*"), source)
        run_snapshot(spark, entity, source, sink, scratch_path(spark, "checkpoint"), at=SNAPSHOT_TIME)
        rows = _read_topic(spark, sink, snapshot_types(entity))
        return show_times(rows.drop("key"), "published_at", "current_time")

    columns = columns_sql(entity, SNAPSHOT_COLUMNS[entity])
    if entity == "videos":
        columns = columns.replace(" category,", f" {category_sql('category_id', True)} AS category,")
    extra = f", {LENGTHS_SQL[entity]}" if entity in ("playlists", "comments") else ""
    sql = f"SELECT {columns}{extra}, CAST({SNAPSHOT_MS} AS BIGINT) AS current_time_ms FROM ({BOUND_SQL[entity]}) AS bound"
    return Query(run, sql)


def snapshot_table_channels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshots of two days, from two runs, and the daily report over the table they fill."""
    source, store = new_topic(spark, "in-channels"), TableStore(scratch_path(spark, "store"))
    df = channels(spark, sf_dir)
    publish(df.select(nested_item(df, "channels").alias("item")).select("item.*"), source)
    for at in ("2024-01-02T03:04:05Z", "2024-01-03T23:59:59Z"):
        run_snapshot_table(spark, "channels", source, store, scratch_path(spark, "checkpoint"), name="channels", at=at)
    changed = report("a26", read_table(spark, store, "channels"))
    return changed.withColumn("snapshot_date", F.col("snapshot_date").cast("string"))


def _dated(entity: str) -> Query:
    message, renames = DATED_MESSAGES[entity], DATED_RENAMES.get(entity, {})
    columns = list(message)

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        source, store = new_topic(spark, f"in-{entity}"), TableStore(scratch_path(spark, "store"))
        df = BOUND[entity](spark, sf_dir)
        if entity in ("playlists", "comments"):
            df = ENRICH[entity](df)
        publish(as_epoch_text(df).select(*columns), source)
        run_dated(spark, entity, source, store, scratch_path(spark, "checkpoint"), name=entity)
        return shown(read_table(spark, store, entity).drop("query_id", "batch_id"))

    selected = []
    for c in columns:
        if c == "published_at":
            selected.append("CAST(epoch_ms(published_at) AS VARCHAR) AS published_at")
        elif c == "duration":
            selected.append(f"CAST({duration_sql('duration')} AS DOUBLE) AS duration_seconds")
        elif c in renames:
            selected.append(f"{c} AS {renames[c]}")
        elif c in ("playlist_title_length", "text_length"):
            selected.append(LENGTHS_SQL[entity])
        else:
            selected.append(c)
    return Query(run, f"SELECT {', '.join(selected)}, {PERIOD_SQL} FROM ({BOUND_SQL[entity]}) AS bound")


def throttled_comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dated comments again, read one file of messages at a time."""
    topic, store = scratch_path(spark, "in-comments"), TableStore(scratch_path(spark, "store"))
    df = as_epoch_text(ENRICH["comments"](BOUND["comments"](spark, sf_dir))).select(*DATED_MESSAGES["comments"])
    publish(df.repartition(3, "comment_id"), Topic(topic))
    source = Topic(topic, options={"maxFilesPerTrigger": "1"})
    run_dated(spark, "comments", source, store, scratch_path(spark, "checkpoint"), name="comments")
    rows = read_table(spark, store, "comments")
    batches = rows.agg(F.count_distinct("batch_id")).scalar()
    return rows.select("comment_id", "year", "month", (batches > 1).alias("several_batches"))


def chained_channels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Channel items to a topic of snapshots, and that topic on to a table."""
    source, between, store = new_topic(spark, "in-channels"), new_topic(spark, "snapshots"), TableStore(scratch_path(spark, "store"))
    df = channels(spark, sf_dir)
    publish(df.select(nested_item(df, "channels").alias("item")).select("item.*"), source)
    run_snapshot(spark, "channels", source, between, scratch_path(spark, "checkpoint"), at=SNAPSHOT_TIME)
    message = snapshot_types("channels")
    to_table = lambda sdf: stream_to_table(sdf, store, "channels", scratch_path(spark, "checkpoint"))
    run_stream(spark, between, lambda sdf: parse_flat(decode_value(sdf), message), to_table)
    return show_times(read_table(spark, store, "channels").drop("query_id", "batch_id"), "published_at", "current_time")


QUERIES: dict[str, Query] = {
    **{f"stream_consume_{entity}": _consume(entity) for entity in ENTITIES},
    **{f"stream_snapshot_{entity}": _snapshot(entity) for entity in ENTITIES},
    **{f"stream_dated_{entity}": _dated(entity) for entity in ENTITIES},
    "stream_throttled_comments": Query(
        throttled_comments, f"SELECT comment_id, {PERIOD_SQL}, true AS several_batches FROM ({BOUND_SQL['comments']}) AS bound"
    ),
    "stream_chained_channels": Query(chained_channels, _snapshot("channels").sql),
    "stream_snapshot_table_channels": Query(
        snapshot_table_channels,
        f"""WITH sums AS (SELECT country, CAST(sum(view_count) AS BIGINT) AS view_count_sum
                          FROM ({BOUND_SQL["channels"]}) AS bound GROUP BY country)
            SELECT country, '2024-01-02' AS snapshot_date, view_count_sum, CAST(NULL AS DOUBLE) AS percent_change FROM sums
            UNION ALL SELECT country, '2024-01-03', view_count_sum, CASE WHEN view_count_sum <> 0 THEN 0.0 END FROM sums""",
    ),
}
