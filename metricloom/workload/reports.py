"""The reports over the bound tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from metricloom.functions import NETWORKS, instant_from_utc
from metricloom.plans.dated import with_publish_period
from metricloom.plans.reports import REPORTS, report
from metricloom.workload.bindings import as_epoch_text, reported, reported_sql, shown
from metricloom.workload.registry import Query, table

NAMES = {
    "a01": "report_a01_views_per_country",
    "a02": "report_a02_videos_per_country",
    "a03": "report_a03_subscribers_per_country_year",
    "a04": "report_a04_channels_by_views",
    "a05": "report_a05_channels_per_year",
    "a06": "report_a06_channels_per_month",
    "a07": "report_a07_playlists_by_videos",
    "a08": "report_a08_playlists_per_title_length_year",
    "a09": "report_a09_playlists_per_year_month",
    "a10": "report_a10_views_per_video_channel",
    "a11": "report_a11_video_views",
    "a12": "report_a12_videos_per_category",
    "a13": "report_a13_videos_per_instagram_mentions",
    "a14": "report_a14_videos_per_twitter_mentions",
    "a15": "report_a15_language_shares",
    "a16": "report_a16_videos_per_year_month",
    "a17": "report_a17_videos_views_likes_durations",
    "a18": "report_a18_duration_per_category",
    "a19": "report_a19_videos_per_category_language",
    "a20": "report_a20_average_duration_per_category_language",
    "a21": "report_a21_comments_per_author",
    "a22": "report_a22_average_length_per_author",
    "a23": "report_a23_likes_per_author",
    "a24": "report_a24_comments_per_year_month",
    "a25": "report_a25_author_profile",
}

# Measures of each report in SQL.
MEASURES_SQL = {
    "a01": "CAST(sum(view_count) AS BIGINT) AS view_count_sum",
    "a02": "CAST(sum(video_count) AS BIGINT) AS video_count_sum",
    "a03": "CAST(sum(subscriber_count) AS BIGINT) AS subscriber_count_sum",
    "a04": "CAST(sum(view_count) AS BIGINT) AS view_count_sum",
    "a05": "count(*) AS channel_count",
    "a06": "count(*) AS channel_count",
    "a07": "CAST(sum(videos_count) AS BIGINT) AS videos_count_sum",
    "a08": "count(*) AS playlist_count",
    "a09": "count(*) AS playlist_count",
    "a10": "CAST(sum(view_count) AS BIGINT) AS view_count_sum",
    "a12": "count(*) AS video_count",
    "a13": "count(*) AS video_count",
    "a14": "count(*) AS video_count",
    "a15": "count(*) AS video_count, CAST(sum(like_count) AS BIGINT) AS like_count_sum,"
    " count(*) * 100 / CAST(sum(count(*)) OVER () AS DOUBLE) AS video_count_percent,"
    " CAST(sum(like_count) AS BIGINT) * 100 / CAST(sum(sum(like_count)) OVER () AS DOUBLE) AS like_count_sum_percent",
    "a16": "count(*) AS video_count",
    "a17": "CAST(sum(view_count) AS BIGINT) AS view_count_sum, CAST(sum(like_count) AS BIGINT) AS like_count_sum,"
    " CAST(sum(duration_seconds) AS DOUBLE) AS duration_seconds_sum",
    "a18": "CAST(sum(duration_seconds) AS DOUBLE) AS duration_seconds_sum",
    "a19": "count(*) AS video_count",
    "a20": "avg(duration_seconds) AS duration_seconds_avg",
    "a21": "count(*) AS comment_count",
    "a22": "avg(text_length) AS text_length_avg",
    "a23": "CAST(sum(comment_like_count) AS BIGINT) AS comment_like_count_sum",
    "a24": "count(*) AS comment_count",
    "a25": "count(*) AS comment_count, CAST(sum(comment_like_count) AS BIGINT) AS comment_like_count_sum,"
    " avg(text_length) AS text_length_avg",
}


# Groups of each report in SQL.
GROUPS_SQL = {
    "a01": "country",
    "a02": "country",
    "a03": 'country, "year"',
    "a04": "channel_id, channel_title",
    "a05": '"year"',
    "a06": '"month"',
    "a07": "playlist_title",
    "a08": '"year", playlist_title_length',
    "a09": '"year", "month"',
    "a10": "video_title, channel_title",
    "a11": "video_title, channel_title, view_count",
    "a12": "category",
    "a13": "instagram_count",
    "a14": "twitter_count",
    "a15": "language",
    "a16": '"year", "month"',
    "a17": "video_id, video_title",
    "a18": "category",
    "a19": "category, language",
    "a20": "category, language",
    "a21": "comment_author_channel_name",
    "a22": "comment_author_channel_name",
    "a23": "comment_author_channel_name",
    "a24": '"year", "month"',
    "a25": "comment_author_channel_name",
}


def _report(name: str) -> Query:
    spec = REPORTS[name]
    groups = GROUPS_SQL[name]
    source = f"({reported_sql(spec.entity)}) AS reported"
    if name in MEASURES_SQL:
        sql = f"SELECT {groups}, {MEASURES_SQL[name]} FROM {source} GROUP BY {groups}"
    else:
        sql = f"SELECT {groups} FROM {source}"
    counted = spec.groups[0].removesuffix("_count")
    networks = (counted,) if counted in NETWORKS else NETWORKS
    return Query(lambda spark, sf_dir: shown(report(name, reported(spark, sf_dir, spec.entity, networks))), sql)


def _dated_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as comments: one author per customer, commenting on the order day."""
    return with_publish_period(
        as_epoch_text(
            table(spark, sf_dir, "orders").select(
                F.col("o_custkey").alias("author"), instant_from_utc("o_orderdate").alias("published_at")
            )
        )
    )


def comments_per_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report("a21", _dated_orders(spark, sf_dir), comment_author_channel_name="author").withColumnRenamed(
        "comment_author_channel_name", "author"
    )


def orders_per_year_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report("a24", _dated_orders(spark, sf_dir))


# --- daily snapshots from events ------------------------------------------------------


def snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as snapshots of the user they belong to: views and likes from the value, the
    number of videos from the JSON properties."""
    user = F.col("user_id")
    nation = table(spark, sf_dir, "nation")
    events = table(spark, sf_dir, "events").join(nation, user % 25 == F.col("n_nationkey"), "left")
    return events.select(
        instant_from_utc("ts").alias("current_time"),
        user.cast("string").alias("id"),
        F.concat(F.lit("title "), (user % 100).cast("string")).alias("title"),
        F.concat(F.lit("channel "), (user % 7).cast("string")).alias("channel_title"),
        F.col("n_name").alias("country"),
        F.round(F.col("value") * 100).cast("bigint").alias("view_count"),
        F.floor("value").cast("bigint").alias("like_count"),
        F.from_json("props", "k int")["k"].alias("videos_count"),
    )


SNAPSHOTS_SQL = """
SELECT ts, CAST(user_id AS VARCHAR) AS id, 'title ' || (user_id % 100) AS title,
       'channel ' || (user_id % 7) AS channel_title, n_name AS country,
       CAST(round(value * 100) AS BIGINT) AS view_count, CAST(floor(value) AS BIGINT) AS like_count,
       CAST(regexp_extract(props, '[0-9]+') AS INTEGER) AS videos_count
FROM events LEFT JOIN nation ON user_id % 25 = n_nationkey"""


def _change(name: str, **columns: str) -> Query:
    spec = REPORTS[name]

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        changed = report(name, snapshots(spark, sf_dir), **{spec.key: "id", **columns})
        return changed.withColumn("snapshot_date", F.col("snapshot_date").cast("string"))

    measure = spec.measure
    named = ", ".join(f"{columns.get(g, g)} AS {g}" for g in spec.groups)
    groups = ", ".join(spec.groups)
    sql = f"""
WITH ranked AS (
  SELECT {named}, CAST(ts AS DATE) AS snapshot_date, {measure},
         row_number() OVER (PARTITION BY id, CAST(ts AS DATE) ORDER BY ts DESC, {measure} DESC) AS nth
  FROM ({SNAPSHOTS_SQL}) AS s),
daily AS (
  SELECT {groups}, snapshot_date, CAST(sum({measure}) AS BIGINT) AS {measure}_sum
  FROM ranked WHERE nth = 1 GROUP BY ALL),
before AS (
  SELECT *, lag({measure}_sum) OVER (PARTITION BY {groups} ORDER BY snapshot_date) AS previous FROM daily)
SELECT {groups}, CAST(snapshot_date AS VARCHAR) AS snapshot_date, {measure}_sum,
       ({measure}_sum - previous) * 100 / CAST(nullif(previous, 0) AS DOUBLE) AS percent_change
FROM before"""
    return Query(run, sql)


QUERIES: dict[str, Query] = {
    **{full: _report(short) for short, full in NAMES.items()},
    "report_a21_comments_per_customer": Query(
        comments_per_customer, "SELECT o_custkey AS author, count(*) AS comment_count FROM orders GROUP BY o_custkey"
    ),
    "report_a24_orders_per_year_month": Query(
        orders_per_year_month,
        """SELECT strftime(o_orderdate, '%Y') AS "year", strftime(o_orderdate, '%B') AS "month",
                  count(*) AS comment_count FROM orders GROUP BY 1, 2""",
    ),
    "pct_change_country": _change("a26"),
    "pct_change_playlists": _change("a27", playlist_title="title"),
    "pct_change_videos": _change("a28", video_title="title"),
}
