"""Envelopes and JSON messages: nesting, parsing, landing and cleansing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from metricloom.functions import instant_from_utc
from metricloom.operators.envelope import (
    flatten_envelope,
    nested_item,
    parse_flat,
    parse_nested,
    project_paths,
    rejects,
    to_json_value,
)
from metricloom.operators.pages import paged_items, to_envelopes
from metricloom.operators.quality import message_counts
from metricloom.plans.cleanse import run_cleanse
from metricloom.schemas import ITEM_FIELDS, KEYS
from metricloom.session import scratch_path
from metricloom.sources.landing import fanout_keys, land_by_key, read_envelopes
from metricloom.sources.tables import TableStore, read_table
from metricloom.workload.bindings import BOUND, BOUND_SQL, columns_sql, raw_videos, show_times
from metricloom.workload.registry import Query, Run, table

# The column whose values name the landing folders of each entity.
FOLDERS = {
    "channels": "country",
    "playlists": "channel_id",
    "videos": "channel_id",
    "comments": "comment_author_channel_id",
}


EVENT_MESSAGE = {"event_id": "bigint", "k": "int"}


def flatten_orders_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as one document per customer and page, as JSON text and back."""
    orders = table(spark, sf_dir, "orders")
    order = F.struct(
        F.col("o_orderkey").alias("id"),
        F.struct(F.col("o_orderstatus").alias("status"), F.struct(F.col("o_totalprice").alias("total")).alias("price")).alias("snippet"),
    )
    documents = to_envelopes(orders, "o_custkey", order, "o_orderkey")
    text = documents.select("o_custkey", F.to_json(F.struct("pageInfo", "items")).alias("value"))
    schema = "items array<struct<id: bigint, snippet: struct<status: string, price: struct<total: double>>>>"
    read = text.select("o_custkey", F.from_json("value", schema).alias("document"))
    items = read.select("o_custkey", F.explode("document.items").alias("item"))
    return project_paths(
        items,
        {
            "o_orderkey": "item.id",
            "o_custkey": "o_custkey",
            "o_orderstatus": "item.snippet.status",
            "o_totalprice": "item.snippet.price.total",
        },
    )


def nested_json_videos(spark: SparkSession, sf_dir: str) -> DataFrame:
    videos = raw_videos(spark, sf_dir)
    messages = videos.select(F.to_json(nested_item(videos, "videos")).alias("value"))
    return show_times(parse_nested(messages, "videos"))


def flat_json_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The real JSON of all events, unaltered but for the key in front, next to the messages
    of all events of which four in ten are broken, wrongly typed, empty or missing."""
    real = table(spark, sf_dir, "events").select(_event_body().alias("value"))
    messages = real.unionByName(event_messages(spark, sf_dir).select("value"))
    read = parse_flat(messages, EVENT_MESSAGE)
    return read.select(F.col("event_id").cast("double").alias("event_id"), F.col("k").cast("double").alias("k"))


def _event_body() -> Column:
    return F.concat(F.lit('{"event_id": '), F.col("event_id").cast("string"), F.lit(", "), F.substr(F.col("props"), F.lit(2)))


def event_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages of all events, four in ten broken, wrongly typed, empty or missing."""
    key, body = F.col("event_id"), _event_body()
    value = (
        F.when(key % 10 == 0, F.rtrim(body, F.lit("}")))
        .when(key % 10 == 1, F.concat(F.lit('{"event_id": '), key.cast("string"), F.lit(', "k": "many"}')))
        .when(key % 10 == 2, "")
        .when(key % 10 == 3, None)
        .otherwise(body)
    )
    return table(spark, sf_dir, "events").select("event_id", value.alias("value"))


def rejects_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rejects(event_messages(spark, sf_dir), EVENT_MESSAGE).select("event_id")


def message_counts_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return message_counts(event_messages(spark, sf_dir), EVENT_MESSAGE, "event_id")


def json_roundtrip_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").withColumn("o_orderdate", instant_from_utc("o_orderdate"))
    messages = to_json_value(orders, key="o_custkey")
    read = parse_flat(
        messages,
        {
            "o_orderkey": "bigint",
            "o_custkey": "bigint",
            "o_orderstatus": "string",
            "o_totalprice": "double",
            "o_orderdate": "timestamp",
            "o_orderpriority": "string",
        },
    )
    return show_times(read, "o_orderdate")


def landing_pages_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where each order stands in the pages of its status; every status has more rows than a task may sort."""
    paged = paged_items(table(spark, sf_dir, "orders"), "o_orderstatus", F.struct("o_orderkey"), "o_orderkey", page_bytes=4000, rows_per_task=100)
    return paged.select(F.col("page_key").alias("o_orderstatus"), F.col("item.o_orderkey").alias("o_orderkey"), "page", "position", "key_rows")


LANDING_PAGES_SQL = """
SELECT o_orderstatus, o_orderkey,
  CAST(sum(15 + length(CAST(o_orderkey AS VARCHAR))) OVER w - (15 + length(CAST(o_orderkey AS VARCHAR))) AS BIGINT) // 4000 AS page,
  row_number() OVER w - 1 AS position, count(*) OVER (PARTITION BY o_orderstatus) AS key_rows
FROM orders WINDOW w AS (PARTITION BY o_orderstatus ORDER BY o_orderkey ROWS UNBOUNDED PRECEDING)"""


def land(spark: SparkSession, sf_dir: str, entity: str) -> str:
    """Land the bound entity as API documents and return the folder."""
    df = BOUND[entity](spark, sf_dir)
    path = scratch_path(spark, f"landing-{entity}")
    rows = df.select(F.col(FOLDERS[entity]).alias("folder"), F.col(KEYS[entity]).alias("row_key"), nested_item(df, entity).alias("item"))
    land_by_key(rows, path, "folder", F.col("item"), "row_key")
    return path


def _cleanse(entity: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        store = TableStore(scratch_path(spark, f"cleansed-{entity}"))
        run_cleanse(spark, entity, land(spark, sf_dir, entity), store, entity)
        return show_times(read_table(spark, store, entity))

    return Query(run, f"SELECT {columns_sql(entity)} FROM ({BOUND_SQL[entity]}) AS bound")


def landing_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items per folder as read back from the landed documents."""
    items = flatten_envelope(read_envelopes(spark, land(spark, sf_dir, "videos"), "videos"), "videos")
    return items.groupBy("channel_id").agg(
        F.count(F.lit(1)).alias("item_count"),
        F.sum(F.length("video_description")).alias("description_chars"),
    )


def _fanout(name: str, key: str, parent: str | None) -> Run:
    return lambda spark, sf_dir: fanout_keys(BOUND[name](spark, sf_dir), key, parent)


_VIDEO_COLUMNS = tuple(f.name for f in ITEM_FIELDS["videos"])

QUERIES: dict[str, Query] = {
    "landing_pages_orders": Query(landing_pages_orders, LANDING_PAGES_SQL),
    "flatten_orders_envelope": Query(
        flatten_orders_envelope, "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders"
    ),
    "nested_json_videos": Query(
        nested_json_videos, f"SELECT {columns_sql('videos', _VIDEO_COLUMNS)} FROM ({BOUND_SQL['videos']}) AS bound"
    ),
    "flat_json_events": Query(
        flat_json_events,
        """SELECT CAST(event_id AS DOUBLE) AS event_id, CAST(regexp_extract(props, '[0-9]+') AS DOUBLE) AS k FROM events
           UNION ALL
           SELECT CASE WHEN event_id % 10 NOT IN (0, 2, 3) THEN CAST(event_id AS DOUBLE) END AS event_id,
                  CASE WHEN event_id % 10 > 3 THEN CAST(regexp_extract(props, '[0-9]+') AS DOUBLE) END AS k
           FROM events""",
    ),
    "rejects_events": Query(rejects_events, "SELECT event_id FROM events WHERE event_id % 10 < 4"),
    "quality_counts_messages": Query(
        message_counts_events,
        """SELECT count(*) AS row_count, count(*) FILTER (WHERE event_id % 10 IN (0, 2, 3)) AS null_key_count,
                  count(*) FILTER (WHERE event_id % 10 < 4) AS reject_count FROM events""",
    ),
    "json_roundtrip_orders": Query(
        json_roundtrip_orders,
        """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority,
                  epoch_ms(o_orderdate) AS o_orderdate_ms FROM orders""",
    ),
    **{f"cleanse_{entity}": _cleanse(entity) for entity in FOLDERS},
    "landing_roundtrip": Query(
        landing_roundtrip,
        f"""SELECT channel_id, count(*) AS item_count, CAST(sum(length(video_description)) AS BIGINT) AS description_chars
            FROM ({BOUND_SQL['videos']}) AS bound GROUP BY channel_id""",
    ),
    "fanout_channel_ids": Query(
        _fanout("videos", "channel_id", None), f"SELECT DISTINCT channel_id FROM ({BOUND_SQL['videos']}) AS bound"
    ),
    "fanout_video_ids": Query(
        _fanout("comments", "video_id", "comment_author_channel_id"),
        f"SELECT DISTINCT comment_author_channel_id, video_id FROM ({BOUND_SQL['comments']}) AS bound",
    ),
}
