"""Scalar operators over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from metricloom.functions import (
    NETWORKS,
    duration_seconds,
    instant_from_utc,
    keyword_count,
    keyword_counts,
    publish_month,
    publish_month_number,
    publish_year,
    strip_punct,
    with_category,
    with_snapshot_time,
    word_count,
)
from metricloom.workload.bindings import (
    VIDEOS_SQL,
    category_sql,
    duration_sql,
    keyword_count_sql,
    raw_videos,
    shown,
    word_count_sql,
)
from metricloom.workload.registry import Query, Run, table

FREQUENT_WORDS = ("the", "of", "and")


def _word_count(name: str, keys: tuple[str, ...], text: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return table(spark, sf_dir, name).select(*keys, word_count(text).alias("words"))

    return Query(run, f"SELECT {', '.join(keys)}, {word_count_sql(text)} AS words FROM {name}")


def _keyword_count(name: str, keys: tuple[str, ...], text: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        counted = keyword_counts(table(spark, sf_dir, name), text, FREQUENT_WORDS)
        return counted.select(*keys, *[f"{w}_count" for w in FREQUENT_WORDS])

    counts = ", ".join(f"{keyword_count_sql(text, w)} AS {w}_count" for w in FREQUENT_WORDS)
    return Query(run, f"SELECT {', '.join(keys)}, {counts} FROM {name}")


def keyword_count_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One keyword, counted in the whole text."""
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", keyword_count("text", "the").alias("the_count"))


def strip_punct_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    clean = strip_punct("text")
    return table(spark, sf_dir, "documents").select(
        "doc_id", F.md5(clean).alias("clean_md5"), F.length(clean).cast("bigint").alias("clean_length")
    )


def network_counts_videos(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = keyword_counts(raw_videos(spark, sf_dir), "video_description")
    return counted.select("video_id", *[f"{n}_count" for n in NETWORKS])


def _epoch_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    millis = F.unix_millis(instant_from_utc("o_orderdate")).cast("string")
    return table(spark, sf_dir, "orders").select("o_orderkey", millis.alias("millis"))


def publish_periods_far(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periods of moments spread over the whole range of a bigint, before and after 1970."""
    far = F.col("o_orderkey") % 1_000_003 * 9_223_000_000_001 * (F.col("o_orderkey") % 2 * 2 - 1)
    return _periods(table(spark, sf_dir, "orders").select("o_orderkey", far.cast("string").alias("millis")))


# Whole quotients rounded downwards, and the calendar of the 400 years from 1970 on, where all repeats.
PERIODS_FAR_SQL = """
WITH m AS (
  SELECT o_orderkey, o_orderkey % 1000003 * 9223000000001 * (o_orderkey % 2 * 2 - 1) AS millis FROM orders),
d AS (
  SELECT *, CASE WHEN millis >= 0 THEN millis // 86400000 ELSE -((86399999 - millis) // 86400000) END AS days FROM m),
c AS (
  SELECT *, CASE WHEN days >= 0 THEN days // 146097 ELSE -((146096 - days) // 146097) END AS cycle FROM d),
p AS (
  SELECT o_orderkey, DATE '1970-01-01' + CAST(days - cycle * 146097 AS INTEGER) AS day, cycle * 400 AS years FROM c),
y AS (SELECT *, year(day) + years AS y FROM p)
SELECT o_orderkey, CASE WHEN y > 9999 THEN '+' WHEN y < 0 THEN '-' ELSE '' END
    || CASE WHEN abs(y) < 10000 THEN lpad(CAST(abs(y) AS VARCHAR), 4, '0') ELSE CAST(abs(y) AS VARCHAR) END AS "year",
  strftime(day, '%m') AS month_number, strftime(day, '%B') AS "month"
FROM y"""


def _periods(df: DataFrame) -> DataFrame:
    return df.select(
        "o_orderkey",
        publish_year("millis").alias("year"),
        publish_month_number("millis").alias("month_number"),
        publish_month("millis").alias("month"),
    )


def publish_year_month_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _periods(_epoch_orders(spark, sf_dir))


def publish_year_month_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every tenth publish time missing, and every tenth but one unreadable."""
    key = F.col("o_orderkey")
    gaps = F.when(key % 10 == 0, None).when(key % 10 == 1, "soon").otherwise(F.col("millis"))
    return _periods(_epoch_orders(spark, sf_dir).select("o_orderkey", gaps.alias("millis")))


def duration_seconds_videos(spark: SparkSession, sf_dir: str) -> DataFrame:
    seconds = duration_seconds("duration").alias("duration_seconds")
    return shown(raw_videos(spark, sf_dir).select("video_id", "duration", seconds))


def _category_names(spaced: bool) -> Run:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return with_category(raw_videos(spark, sf_dir), spaced).select("video_id", "category_id", "category")

    return run


def category_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = with_category(raw_videos(spark, sf_dir))
    return named.groupBy("category").agg(F.count(F.lit(1)).alias("video_count"))


SNAPSHOT_TIME = "2024-01-02T03:04:05Z"
SNAPSHOT_MS = 1_704_164_645_000


def snapshot_time_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    timed = with_snapshot_time(table(spark, sf_dir, "events").select("event_id"), SNAPSHOT_TIME)
    return timed.select("event_id", F.unix_millis("current_time").alias("current_time_ms"))


_CATEGORY_SQL = "SELECT video_id, category_id, {} AS category FROM (" + VIDEOS_SQL + ") AS v"

QUERIES: dict[str, Query] = {
    "publish_periods_far": Query(publish_periods_far, PERIODS_FAR_SQL),
    "word_count_documents": _word_count("documents", ("doc_id",), "text"),
    "word_count_conversations": _word_count("conversations", ("conv_id", "turn"), "text"),
    "word_count_pages": _word_count("pages", ("page_id",), "html"),
    "keyword_counts_documents": _keyword_count("documents", ("doc_id",), "text"),
    "keyword_counts_pages": _keyword_count("pages", ("page_id",), "html"),
    "keyword_count_conversations": Query(
        keyword_count_conversations,
        f"SELECT conv_id, turn, {keyword_count_sql('text', 'the')} AS the_count FROM conversations",
    ),
    "strip_punct_documents": Query(
        strip_punct_documents,
        """SELECT doc_id, md5(regexp_replace(text, '[[:punct:]]', '', 'g')) AS clean_md5,
                  length(regexp_replace(text, '[[:punct:]]', '', 'g')) AS clean_length
           FROM documents""",
    ),
    "network_counts_videos": Query(
        network_counts_videos,
        "SELECT video_id, "
        + ", ".join(f"{keyword_count_sql('video_description', n)} AS {n}_count" for n in NETWORKS)
        + f" FROM ({VIDEOS_SQL}) AS v",
    ),
    "publish_year_month_orders": Query(
        publish_year_month_orders,
        """SELECT o_orderkey, strftime(o_orderdate, '%Y') AS "year", strftime(o_orderdate, '%m') AS month_number,
                  strftime(o_orderdate, '%B') AS "month" FROM orders""",
    ),
    "publish_year_month_null": Query(
        publish_year_month_null,
        """SELECT o_orderkey,
                  CASE o_orderkey % 10 WHEN 0 THEN 'n/a' WHEN 1 THEN NULL ELSE strftime(o_orderdate, '%Y') END AS "year",
                  CASE o_orderkey % 10 WHEN 0 THEN 'n/a' WHEN 1 THEN NULL ELSE strftime(o_orderdate, '%m') END AS month_number,
                  CASE WHEN o_orderkey % 10 > 1 THEN strftime(o_orderdate, '%B') END AS "month"
           FROM orders""",
    ),
    "duration_seconds_videos": Query(
        duration_seconds_videos,
        f"SELECT video_id, duration, CAST({duration_sql('duration')} AS DOUBLE) AS duration_seconds FROM ({VIDEOS_SQL}) AS v",
    ),
    "category_names_videos": Query(_category_names(False), _CATEGORY_SQL.format("category")),
    "category_names_spaced": Query(_category_names(True), _CATEGORY_SQL.format(category_sql("category_id", True))),
    "category_counts": Query(
        category_counts, f"SELECT category, count(*) AS video_count FROM ({VIDEOS_SQL}) AS v GROUP BY category"
    ),
    "snapshot_time_events": Query(
        snapshot_time_events, f"SELECT event_id, CAST({SNAPSHOT_MS} AS BIGINT) AS current_time_ms FROM events"
    ),
}
